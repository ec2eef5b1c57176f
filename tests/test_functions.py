import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom import functions as fn
from tests.conftest import rows

D = dt.date


@pytest.mark.parametrize("as_of, start", [
    (D(2021, 1, 4), D(2020, 12, 28)), (D(2024, 12, 30), D(2024, 12, 23)), (D(2024, 1, 17), D(2024, 1, 8)),
    ("2024-01-14", D(2024, 1, 1)), (dt.datetime(2024, 1, 15, 13), D(2024, 1, 8)),
])
def test_previous_week_starts_on_monday(as_of, start):
    assert fn.previous_week(as_of) == (start, start + dt.timedelta(days=7))


def test_iso_week_at_year_edges(spark):
    days = [D(2021, 1, 3), D(2021, 1, 4), D(2024, 12, 29), D(2024, 12, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.orderBy("d").select(fn.iso_week("d")).collect()] == [53, 1, 52, 1]


def test_date_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 9, 23, 59, 59),), (None,)], "t timestamp_ntz")
    out = df.select(
        fn.date_key("t"), fn.timestamp_to_date("t"), fn.day_num("t"), fn.month_num("t"),
        fn.month_name("t"), fn.year_num("t"), fn.week_start("t"))
    assert rows(out)[0] == (20240209, D(2024, 2, 9), 9, 2, "Feb", 2024, D(2024, 2, 5))
    assert rows(out)[1] == (None,) * 7


def test_half_open_filters(spark):
    stamps = ["2024-01-07 23:59:59", "2024-01-08 00:00:00", "2024-01-14 23:59:59.999999", "2024-01-15 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert df.where(fn.previous_week_filter("t", "2024-01-17")).count() == 2
    assert df.where(fn.business_date_filter("t", "2024-01-14")).count() == 1


def test_safe_ratio(spark):
    df = spark.createDataFrame([(Decimal("10.00"), 3), (Decimal("10.00"), 0), (Decimal("0.01"), 2), (None, 1)],
                               "a decimal(14,2), b bigint")
    out = [r[0] for r in df.select(fn.safe_ratio(F.col("a"), F.col("b")).cast("decimal(10,2)")).collect()]
    assert out == [Decimal("3.33"), None, Decimal("0.01"), None]


def test_text_and_status(spark):
    df = spark.createDataFrame([("latest",), ("TEST",), (None,), ("",), ("shipped",), ("Refunded",)], "s string")
    found = {r[0]: r[1] for r in df.select("s", fn.is_test_text("s")).collect()}
    assert found == {"latest": True, "TEST": True, None: False, "": False, "shipped": False, "Refunded": False}
    assert rows(df.where(fn.status_filter("s"))) == [("shipped",)]


def test_refund_sign_and_label(spark):
    df = spark.createDataFrame([(5, "refunded"), (5, "shipped"), (5, None), (None, "refunded")], "q int, s string")
    assert [r[0] for r in df.select(fn.refund_sign("q", "s")).collect()] == [-5, 5, 5, None]
    assert [r[0] for r in df.select(fn.label_concat("q")).collect()] == ["category_5"] * 3 + [None]
