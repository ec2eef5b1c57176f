import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.schemas import TABLES
from martloom.operators import cleaning
from martloom.session import scratch_path
from martloom.sources import files
from martloom.sources.key_index import KeyIndex
from martloom.sources.warehouse import (
    Warehouse, add_column, append_table, finish_replace, last_tag, merge_evolved, overwrite_table, packed_id,
    replace_partitions, row_ids,
)
from tests.conftest import plan_text, rows

D = dt.date


def day(v):
    return F.lit(v).cast("date")


def test_rerun_of_a_date_replaces_it(spark):
    path = scratch_path(spark, "t")
    df = spark.range(10).select("id", F.when(F.col("id") < 5, day("2024-01-01")).otherwise(day("2024-01-02")).alias("d"))
    replace_partitions(df, path, "d")
    replace_partitions(df.where("id = 7"), path, "d", [D(2024, 1, 2)])
    assert sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == [0, 1, 2, 3, 4, 7]


def test_date_without_rows_is_emptied(spark):
    path = scratch_path(spark, "t")
    df = spark.range(4).select("id", F.when(F.col("id") < 2, day("2024-01-01")).otherwise(day("2024-01-02")).alias("d"))
    replace_partitions(df, path, "d")
    replace_partitions(df.where("id < 0"), path, "d", [D(2024, 1, 2)])
    table = spark.read.schema(df.schema).parquet(path)
    assert rows(table, "id", "d") == [(0, D(2024, 1, 1)), (1, D(2024, 1, 1))]
    # a first run with no rows at all
    empty = scratch_path(spark, "t")
    replace_partitions(df.where("id < 0"), empty, "d", [D(2024, 1, 2)])
    assert spark.read.schema(df.schema).parquet(empty).count() == 0


def test_a_replacement_happens_as_a_whole(spark, monkeypatch):
    """A run that ends before the commit record leaves the old state, one that ends after it is completed."""
    path = scratch_path(spark, "t")
    old = spark.range(6).select("id", F.date_add(day("2024-01-01"), (F.col("id") % 3).cast("int")).alias("d"))
    new = old.withColumn("id", F.col("id") + 100).where("d < date'2024-01-03'")
    days = [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)]
    replace_partitions(old, path, "d")
    read = lambda: rows(spark.read.schema(old.schema).parquet(path))
    before = read()

    class Crash(Exception):
        pass

    def crash(*_):
        raise Crash

    for step in ("write_text", "move", "delete"):
        with monkeypatch.context() as patch:
            if step != "write_text":
                done = []
                real = getattr(files, step)
                patch.setattr(files, step, lambda *a: crash() if len(done) == 1 else (done.append(1), real(*a)))
            else:
                patch.setattr(files, step, crash)
            with pytest.raises(Crash):
                replace_partitions(new, path, "d", days)
        if step == "write_text":
            assert read() == before
        else:
            finish_replace(spark, path)
            finish_replace(spark, path)
            assert read() == rows(new)
            replace_partitions(old, path, "d", days)
            assert read() == before
    # what a crash left behind is no data, and tags name committed loads only
    replace_partitions(new, path, "d", days, tag="load 7")
    assert read() == rows(new) and last_tag(spark, path) == "load 7"


def test_dates_are_emptied_by_one_write(spark):
    path = scratch_path(spark, "t")
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    df = spark.range(400).select("id", F.date_add(day("2024-01-01"), (F.col("id") % 40).cast("int")).alias("d"))
    replace_partitions(df, path, "d")
    spark.sparkContext.setJobGroup("emptied", "")
    replace_partitions(df.where("id < 3"), path, "d", days)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("emptied")
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) <= 2 and spark.read.schema(df.schema).parquet(path).count() == 3


def test_key_index(spark):
    from pyspark.sql import types as T

    path = scratch_path(spark, "index")
    key = [T.StructField("uniq_id", T.StringType())]
    index = KeyIndex(spark, path, key, "load_date")
    keys = spark.range(1000).select(F.col("id").cast("string").alias("uniq_id"))
    index.replace(keys.where("uniq_id < '5'"), "2024-01-01")
    index.replace(keys.where("uniq_id >= '5'"), "2024-02-01")
    index.replace(keys.where("uniq_id >= '6'"), "2024-02-01")
    rows_ = spark.createDataFrame([(u, 1) for u in [*map(str, range(1000)), None, "x"]], "uniq_id string, v int")
    unseen = index.unknown(rows_)
    want = {str(i) for i in range(1000) if str(i)[0] == "5"} | {None, "x"}
    assert {r.uniq_id for r in unseen.collect()} == want
    assert index.known(rows_).count() == 1000 - 111
    assert index.known(rows_, since="2024-01-15").count() == sum(str(i) >= "6" for i in range(1000))
    # another session finds the stored buckets
    spark.sql(f"drop table {index.name}")
    again = KeyIndex(spark, path, key, "load_date")
    assert again.known(rows_).count() == 1000 - 111
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(cleaning.dedup_against_index(rows_, again, since="2024-01-15"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored_side = plan[plan.index("LeftAnti"):].split("FileScan parquet")[-1]
    print(plan)
    assert plan.count("Exchange hashpartitioning") == 1 and "PartitionFilters: [isnotnull(load_date" in stored_side
    assert cleaning.dedup_against_index(rows_, again).count() == 113


def test_append_repeats_and_overwrite_replaces(spark):
    path = scratch_path(spark, "t")
    df = spark.range(3)
    append_table(df, path)
    append_table(df, path)
    assert spark.read.parquet(path).count() == 6
    overwrite_table(spark.read.parquet(path).distinct(), path, reads_target=True)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]


def test_staging_ids_are_unique_over_loads(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.create_tables(["staging.user_activity_log"])
    base = spark.range(0, 500, 1, 4).select(
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("date_time"), F.lit(1).alias("action_id"),
        F.col("id").alias("customer_id"), F.lit(1).alias("quantity"))
    for d in ("2024-01-01", "2024-01-02", "2024-01-02"):
        wh.replace("staging.user_activity_log", base.withColumn("load_date", day(d)), [D.fromisoformat(d)])
    table = wh.read("staging.user_activity_log")
    assert table.count() == 1000 == table.select("id").distinct().count()
    assert table.where("id is null or id < 0").count() == 0


def test_row_ids_grow_with_the_load_date(spark):
    ids = [spark.range(5).select(row_ids(day(d)).alias("i")).agg(F.min("i"), F.max("i")).first()
           for d in ("2024-01-01", "2024-01-02", "2060-01-01", "2149-06-06")]
    assert 0 < ids[0][0] <= ids[0][1] < ids[1][0] <= ids[1][1] < ids[2][0] < ids[3][0]


def test_ids_of_very_large_loads(spark):
    def number(*parts):
        return spark.range(1).select(packed_id(*[F.lit(p).cast("bigint") for p in parts]).alias("i")).first()["i"]

    assert number(0, 1 << 17, 0) > number(0, (1 << 17) - 1, (1 << 25) - 1) > number(0, (1 << 17) - 1, 0)
    assert number((1 << 16) - 1, (1 << 22) - 1, (1 << 25) - 1) == (1 << 63) - 1
    for bad in ((-1, 0, 0), (1 << 16, 0, 0), (0, 1 << 22, 0), (0, 0, 1 << 25)):
        with pytest.raises(Exception, match="out of the id range"):
            number(*bad)


def test_schema_evolution(spark):
    old = spark.createDataFrame([(1,)], "v int")
    new = spark.createDataFrame([("shipped", 2)], "status string, v int")
    assert rows(merge_evolved(old, new), "v", "status") == [(1, None), (2, "shipped")]
    assert rows(add_column(old, "status", "string")) == [(1, None)]
    assert add_column(new, "status", "string") is new


def test_create_tables(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    assert not wh.exists("mart.d_city")
    wh.create_tables()
    for name, spec in TABLES.items():
        table = wh.read(name)
        assert table.count() == 0 and table.schema.fieldNames() == spec.columns
    wh.append("mart.d_city", spark.createDataFrame([(1, 2, "Rome")], "id bigint, city_id bigint, city_name string"))
    wh.create_tables(if_absent=True)
    assert wh.read("mart.d_city").count() == 1
    wh.create_tables(["mart.d_city"])
    assert wh.read("mart.d_city").count() == 0


def test_load_history(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.create_tables()
    cities = spark.createDataFrame([(1, 2, "Rome")], "id bigint, city_id bigint, city_name string")
    wh.append("mart.d_city", cities, batch_id=3)
    wh.append("mart.d_city", cities)
    wh.append("mart.d_city", cities.union(cities), batch_id=3)
    wh.append("mart.d_city", cities.limit(0), batch_id=4)
    row, empty = wh.read("mart.load_history").orderBy("batch_id").collect()
    # a repeated load of a batch replaces its row
    assert row["row_count"] == 2 and empty["row_count"] == 0
    assert (row["batch_id"], row["target_table"]) == (3, "mart.d_city")
    assert row["start_load"] <= row["finish_load"]
