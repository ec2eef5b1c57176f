import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.cleaning import dedup_if_keyed
from martloom.session import scratch_path
from martloom.sources.csv_files import FILE, POSITION, read_csv_by_name
from martloom.streaming import stream_ingest
from tests.conftest import rows

SCHEMA = T.StructType([
    T.StructField("uniq_id", T.StringType()), T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("quantity", T.LongType())])


def land(folder, name, *lines, head="uniq_id,date_time,quantity"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join((head, *lines)) + "\n")


def run(spark, landed, target, offsets, **options):
    query = stream_ingest(spark, landed, SCHEMA, target, offsets, fmt="csv", files_per_batch=1, **options)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return spark.read.parquet(target)


@pytest.fixture
def landed(spark):
    folder = scratch_path(spark, "landed")
    land(folder, "1.csv", "a,2024-01-01 10:00:00,1", "a,2024-01-01 11:00:00,2", ",2024-01-01 12:00:00,3", "NA,2024-01-01 12:00:00,4")
    land(folder, "2.csv", "a,2023-01-01 10:00:00,5", "b,2024-01-02 11:00:00,6.0")
    return folder


def test_first_row_per_file_as_in_the_daily_load(spark, landed):
    target, offsets = scratch_path(spark, "target"), scratch_path(spark, "offsets")
    got = rows(run(spark, landed, target, offsets, fill_status=True), "uniq_id", "quantity", "status")
    daily = dedup_if_keyed(read_csv_by_name(spark, landed).withColumn(
        "uniq_id", F.when(F.col("uniq_id") != "NA", F.col("uniq_id"))), "uniq_id", [POSITION], [FILE])
    assert got == rows(daily.select("uniq_id", F.col("quantity").cast("double").cast("bigint"), F.lit("shipped").alias("status")))
    assert [r[1] for r in got] == [1, 5, 6, 3]

    # only new files are loaded by the next run
    land(landed, "3.csv", "c,2020-01-01 00:00:00,7")
    assert run(spark, landed, target, offsets, fill_status=True).count() == 5


def test_across_files_keeps_late_rows_and_drops_repeated_keys(spark, landed):
    target, offsets = scratch_path(spark, "target"), scratch_path(spark, "offsets")
    table = run(spark, landed, target, offsets, across_files=True)
    land(landed, "3.csv", "c,2000-01-01 00:00:00,7", "b,2024-01-02 11:00:00,8")
    table = run(spark, landed, target, offsets, across_files=True)
    assert sorted(r[0] for r in table.where("uniq_id is not null").select("uniq_id").collect()) == ["a", "b", "c"]
    assert table.where("uniq_id = 'c'").count() == 1


def test_repeated_batch_does_not_add_rows(spark, landed):
    target = scratch_path(spark, "target")
    first = rows(run(spark, landed, target, scratch_path(spark, "offsets")), "uniq_id", "quantity")
    # lost progress: the same batches run again
    again = rows(run(spark, landed, target, scratch_path(spark, "offsets")), "uniq_id", "quantity")
    assert again == first


def test_other_header_stops(spark, landed):
    land(landed, "4.csv", "1,2024-01-02 11:00:00,x", head="quantity,date_time,uniq_id")
    with pytest.raises(Exception):
        run(spark, landed, scratch_path(spark, "target"), scratch_path(spark, "offsets"))
