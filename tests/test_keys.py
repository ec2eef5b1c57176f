import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators.keys import new_keys_not_in, surrogate_ids
from tests.conftest import plan_text, rows

PROBES = [[], [1, 2, None, None, 3], [None]]
DIMS = [[], [None], [1, None], [1, 2, 2], [7]]


def frame(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def sql_not_in(spark, probe, dim):
    frame(spark, probe, "k").createOrReplaceTempView("probe_v")
    frame(spark, dim, "d").createOrReplaceTempView("dim_v")
    return rows(spark.sql("select k from probe_v where k not in (select d from dim_v)"))


@pytest.mark.parametrize("probe, dim", list(itertools.product(PROBES, DIMS)))
def test_not_in_with_nulls(spark, probe, dim):
    got = rows(new_keys_not_in(frame(spark, probe, "k"), "k", frame(spark, dim, "d"), "d"))
    assert got == sql_not_in(spark, probe, dim)


keys = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(probe=keys, dim=keys)
def test_not_in_random(spark, probe, dim):
    got = rows(new_keys_not_in(frame(spark, probe, "k"), "k", frame(spark, dim, "d"), "d"))
    assert got == sql_not_in(spark, probe, dim)


def test_not_in_leaves_the_join_strategy_open(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(new_keys_not_in(spark.range(100).toDF("k"), "k", spark.range(50).toDF("d"), "d"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftAnti" in plan
    assert "Broadcast" not in plan


def number(spark, df, order):
    df.createOrReplaceTempView("to_number")
    return rows(spark.sql(f"select row_number() over (order by {order}) id, * from to_number"))


def test_ids_equal_row_number(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).cast("int").alias("k"))
    df = df.unionByName(spark.createDataFrame([(None,)], "k int")).repartition(7)
    assert rows(surrogate_ids(df, ["k"])) == number(spark, df, "k nulls first")


def test_ids_where_one_first_key_holds_most_rows(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") < 1800, 5).otherwise(F.col("id").cast("int")).alias("k"),
        F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"))
    ids = surrogate_ids(df, ["k", "name"])
    assert rows(ids) == number(spark, df, "k, name")


def test_ids_continue_after_the_existing(spark):
    known = spark.createDataFrame([(4,), (9,)], "id bigint")
    df = spark.createDataFrame([("b",), ("a",)], "k string")
    assert rows(surrogate_ids(df, ["k"], existing=known)) == [(10, "a"), (11, "b")]
    assert rows(surrogate_ids(df, ["k"], existing=known.where("false"))) == [(1, "a"), (2, "b")]
    assert rows(surrogate_ids(df.where("false"), ["k"], existing=known)) == []
