from pyspark.sql import functions as F

from martloom.operators import cleaning
from martloom.session import scratch_path
from martloom.sources.csv_files import FILE, POSITION, read_csv_by_name
from tests.conftest import plan_text, rows


def test_keep_first_with_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), (None, 3, "p"), (None, 4, "q"), ("b", 5, None)], "k string, o int, v string")
    for n in (1, 3, 8):
        got = cleaning.dedup_keep_first(df.repartition(n), ["k"], ["o"])
        assert rows(got) == rows(df.where("o in (1, 3, 5)"))
    assert got.columns == ["k", "o", "v"]


def test_keep_first_keeps_a_row_whose_order_is_null(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", 1, "y")], "k string, o int, v string")
    assert cleaning.dedup_keep_first(df, ["k"], ["o"]).count() == 2


def test_keep_first_reduces_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    plan = plan_text(cleaning.dedup_keep_first(df, ["k"], ["o"]), "simple")
    assert plan.index("SortAggregate") < plan.index("Exchange") < plan.rindex("partial_min_by")


def test_first_row_in_file_order_over_many_splits(spark):
    path = scratch_path(spark, "dups")
    lines = spark.range(0, 20000, 1, 1).select(
        F.when(F.col("id") % 2 == 0, (F.col("id") % 500).cast("string")).alias("uniq_id"), F.col("id").alias("v"))
    lines.write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = read_csv_by_name(spark, path)
        assert raw.rdd.getNumPartitions() > 5
        got = cleaning.dedup_if_keyed(raw, "uniq_id", [POSITION], [FILE]).select("uniq_id", F.col("v").cast("int"))
        want = [(str(i), i) for i in range(0, 500, 2)] + [(None, 1)]
        assert rows(got) == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_without_key_column_all_rows_stay(spark):
    df = spark.createDataFrame([(1,), (1,)], "v int")
    assert cleaning.dedup_if_keyed(df, "uniq_id", ["v"]).count() == 2


def test_against_history(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "uniq_id string, v int")
    seen = spark.createDataFrame([("a",), (None,)], "uniq_id string")
    assert rows(cleaning.dedup_against_history(df, seen)) == [("b", 2), (None, 3)]


def test_status_default_only_where_the_column_is_absent(spark):
    absent = spark.createDataFrame([(1,)], "v int")
    present = spark.createDataFrame([(1, None)], "v int, status string")
    assert rows(cleaning.default_missing_column(absent)) == [(1, "shipped")]
    assert rows(cleaning.default_missing_column(present)) == [(1, None)]
