import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from martloom.plans import runs
from martloom.plans.stream import stream_to_marts
from martloom.session import scratch_path
from martloom.sources.landing import Landing
from martloom.sources.warehouse import Warehouse
from martloom.streaming.keyed import NEW_KEY, with_new_keys
from tests.conftest import rows
from tests.test_runs import ORDER_HEAD, land, order, put

HEAD = ORDER_HEAD.removeprefix("id,") + ",status"
LAYOUT = "{root}/{dataset}/increment={increment}"
TABLES = ("mart.d_calendar", "mart.d_customer", "mart.d_item", "mart.d_city", "mart.f_sales", "mart.f_customer_retention",
          "mart.f_daily_sales_signed")


def line(*args, **more):
    return order(*args, status=more.pop("status", "shipped"), **more).split(",", 1)[1]


def files_of(landing, day, name, *lines):
    put(f"{landing.path(day, 'user_order_log')}/{name}.csv", HEAD, *lines)


def stream(spark, landing, root, offsets, **options):
    query = stream_to_marts(spark, landing, root, offsets, files_per_batch=1, **options)
    query.awaitTermination()
    return query


def daily(spark, *orders):
    """The warehouse of a back-fill that gets each order once."""
    landing, root = Landing(scratch_path(spark, "landing")), scratch_path(spark, "daily")
    by_day = {}
    for day, text in orders:
        by_day.setdefault(day, []).append("0," + text)
    for day, lines in by_day.items():
        land(landing, day, lines)
        put(landing.path(day, "user_activity_log"), "uniq_id,date_time,action_id,customer_id,quantity,action")
        put(landing.path(day, "customer_research"), "date_id,category_id,geo_id,sales_qty,sales_amt")
    days = sorted(by_day)
    for day in days:
        wh = runs.run_backfill(spark, landing, root, day, day)
    return wh


def same(got, wanted):
    for table in TABLES:
        skip = ["id"] if "id" in got.read(table).columns else []
        assert rows(got.read(table).drop(*skip)) == rows(wanted.read(table).drop(*skip)), table


A = ("2024-01-03", line("a", "2024-01-03 10:00:00"))
B = ("2024-01-03", line("b", "2024-01-03 12:00:00", customer=2, status="refunded", pay="4.00"))
C = ("2024-01-04", line("c", "2024-01-04 10:00:00", item=8))
LATE = ("2024-01-04", line("late", "2024-01-03 09:00:00", customer=3))
NOBODY = ("2024-01-04", line("", "2024-01-04 11:00:00", customer=4))


def landed(spark):
    landing = Landing(scratch_path(spark, "landing"), LAYOUT)
    files_of(landing, "2024-01-03", "1", A[1], line("a", "2024-01-03 11:00:00", pay="99.00"))
    files_of(landing, "2024-01-03", "2", B[1])  # an increment in two files
    time.sleep(0.05)
    files_of(landing, "2024-01-04", "1", A[1], C[1], C[1], LATE[1], NOBODY[1])
    return landing


def test_repeated_orders_are_dropped_across_files_and_late_ones_repair_their_date(spark):
    landing, root, offsets = landed(spark), scratch_path(spark, "root"), scratch_path(spark, "offsets")
    stream(spark, landing, root, offsets)
    wanted = daily(spark, A, B, C, LATE, NOBODY)
    same(Warehouse(spark, root), wanted)
    assert rows(Warehouse(spark, root).read("staging.user_order_log").select("load_date", "uniq_id")) == rows(
        wanted.read("staging.user_order_log").select("load_date", "uniq_id"))

    # the next run knows the keys of the last one; its state has one entry per key, whatever the rows
    D = ("2024-01-05", line("d", "2024-01-05 10:00:00"))
    files_of(landing, "2024-01-05", "1", D[1], B[1], LATE[1])
    query = stream(spark, landing, root, offsets)
    same(Warehouse(spark, root), daily(spark, A, B, C, LATE, NOBODY, D))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 5
    stream(spark, landing, root, offsets)  # nothing new


def test_a_run_that_fails_between_staging_and_marts_is_completed_by_the_next(spark, monkeypatch):
    landing, root, offsets = landed(spark), scratch_path(spark, "root"), scratch_path(spark, "offsets")
    real, calls = runs.refresh_marts, []

    def failing(*args, **more):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **more)

    monkeypatch.setattr(runs, "refresh_marts", failing)
    with pytest.raises(StreamingQueryException):
        stream(spark, landing, root, offsets)
    stream(spark, landing, root, offsets)
    same(Warehouse(spark, root), daily(spark, A, B, C, LATE, NOBODY))
    assert Warehouse(spark, root).read("staging.user_order_log").count() == 5


def test_bad_rows_are_set_aside_once(spark):
    landing, root, offsets = Landing(scratch_path(spark, "landing"), LAYOUT), scratch_path(spark, "root"), scratch_path(spark, "offsets")
    bad = [line(k, "2024-01-03 10:00:00", status="test") for k in ("x", "y")]
    files_of(landing, "2024-01-03", "1", A[1], bad[0])
    files_of(landing, "2024-01-03", "2", B[1], bad[1], bad[0])
    with pytest.raises(StreamingQueryException):
        stream(spark, landing, scratch_path(spark, "other"), scratch_path(spark, "offsets"))
    stream(spark, landing, root, offsets, bad_rows="quarantine")
    wh = Warehouse(spark, root)
    assert [r[0] for r in rows(runs.read_quarantine(wh, "user_order_log").select("uniq_id"))] == ["x", "y"]
    same(wh, daily(spark, A, B))


def test_keys_are_forgotten_after_the_horizon(spark):
    folder, target, offsets = (scratch_path(spark, n) for n in ("in", "out", "offsets"))
    found = []
    for name in ("a", "b", "c", "a"):
        spark.createDataFrame([(name, 1), (name, 2), (None, 3)], "k string, v int").coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema("k string, v int").parquet(folder)
        with_new_keys(source, "k", "1 second").writeStream.option("checkpointLocation", offsets).trigger(
            availableNow=True).format("parquet").start(target).awaitTermination()
        found.append(spark.read.parquet(target).where(NEW_KEY).count())
        time.sleep(2.2)
    assert found == [1, 2, 3, 4]
    assert spark.read.parquet(target).where(~F.col(NEW_KEY)).count() == 12
