import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from martloom.operators import facts
from martloom.operators.dimensions import d_customer_full, d_customer_new
from martloom.plans import inputs
from martloom.plans.catalog.marts import SALES_COLUMNS
from tests.conftest import DATA, plan_text, rows

SCHEMA = ("uniq_id string, date_time timestamp_ntz, city_id int, customer_id bigint, item_id int, quantity bigint, "
          "payment_amount decimal(14,2), status string")


def orders(spark, *lines):
    return spark.createDataFrame(
        [(u, dt.datetime.fromisoformat(t), 1, c, i, q, None if p is None else Dec(p), s) for u, t, c, i, q, p, s in lines],
        SCHEMA)


@pytest.fixture(scope="module")
def web(spark):
    return inputs.web_order_log(spark, DATA).withColumn("city_id", F.lit(1)).cache()


def calendar(spark, *days):
    return spark.createDataFrame(
        [(int(d.replace("-", "")), dt.date.fromisoformat(d)) for d in days], "date_id int, fact_date date")


def test_retention_counts(spark):
    df = orders(
        spark,
        ("a", "2024-01-08 00:00:00", 1, 7, 1, "10.00", "shipped"),   # customer 1: one order
        ("b", "2024-01-09 00:00:00", 2, 7, 1, "5.00", "refunded"),   # customer 2: two orders, one refund
        ("c", "2024-01-14 23:59:59", 2, 7, 1, "6.00", None),
        (None, "2024-01-10 00:00:00", 3, 7, 1, "100.00", "refunded"),  # no order id: neither new nor returning
        ("d", "2024-01-10 00:00:00", None, 7, 1, "1.00", "refunded"),  # no customer: revenue and refund only
        ("e", "2024-01-15 00:00:00", 1, 7, 1, "99.00", "shipped"),   # next week
    )
    got = facts.f_customer_retention(df, "2024-01-17")
    assert rows(got) == [(1, 1, 2, "weekly", 3, 7, Dec("11.00"), Dec("11.00"), 3)]
    signed = facts.f_customer_retention(df, "2024-01-17", signed=True)
    assert rows(signed, "new_customers_revenue", "returning_customers_revenue") == [(Dec("9.00"), Dec("1.00"))]
    labelled = facts.f_customer_retention(df, "2024-01-17", label="data_week")
    assert rows(labelled, "period_id") == [(2,)]
    with pytest.raises(ValueError):
        facts.f_customer_retention(df, "2024-01-17", label="month")


@pytest.mark.parametrize("as_of, run_week, data_week", [("2021-01-04", 1, 53), ("2024-12-30", 1, 52)])
def test_retention_label_at_year_edges(spark, as_of, run_week, data_week):
    before = (dt.date.fromisoformat(as_of) - dt.timedelta(days=1)).isoformat()
    df = orders(spark, ("a", f"{before} 12:00:00", 1, 7, 1, "1.00", "shipped"))
    assert rows(facts.f_customer_retention(df, as_of), "period_id") == [(run_week,)]
    assert rows(facts.f_customer_retention(df, as_of, label="data_week"), "period_id") == [(data_week,)]


def test_known_week(web):
    got = {r["item_id"]: r for r in facts.f_customer_retention(web, "2024-01-17").collect()}
    r = got[0]
    assert len(got) == 20
    assert (r["new_customers_count"], r["returning_customers_count"], r["refunded_customer_count"]) == (57, 27, 25)
    assert (r["new_customers_revenue"], r["returning_customers_revenue"], r["customers_refunded"]) == (
        Dec("2487.19"), Dec("3092.82"), 28)


@pytest.mark.parametrize("label", ["run_week", "data_week"])
@pytest.mark.parametrize("signed", [False, True])
def test_backfill_equals_single_weeks(web, label, signed):
    everything = facts.retention_backfill(web, label=label, signed=signed)
    for monday in ("2024-01-01", "2024-01-15", "2024-01-29"):
        week = everything.where(F.col("week_start") == F.lit(monday).cast("date")).drop("week_start")
        as_of = dt.date.fromisoformat(monday) + dt.timedelta(days=9)
        assert rows(week) == rows(facts.f_customer_retention(web, as_of, label, signed))
    part = facts.retention_backfill(web, "2024-01-10", "2024-01-17")
    assert sorted({r["week_start"] for r in part.collect()}) == [dt.date(2024, 1, 8), dt.date(2024, 1, 15)]


def test_sales_backfill_equals_single_days(spark, web):
    cal = calendar(spark, "2024-01-03", "2024-01-04")
    everything = facts.f_sales_backfill(web, cal, "2024-01-03", "2024-01-05")
    total = 0
    for day in ("2024-01-03", "2024-01-04", "2024-01-05"):
        one = rows(facts.f_sales(web, cal, day))
        total += len(one)
        assert rows(everything.where(F.col("sale_date") == F.lit(day).cast("date")).drop("sale_date")) == one
    assert total == everything.count() > 0
    assert {r[0] for r in facts.f_sales(web, cal, "2024-01-05").select("date_id").collect()} == {None}


def test_signed_daily_totals_equal_row_level(spark):
    log = inputs.order_log(spark, DATA, *SALES_COLUMNS)
    daily = facts.f_daily_sales_signed(log).agg(F.sum("payment_amount"), F.sum("quantity")).first()
    rowwise = facts.f_sales_backfill(log, calendar(spark), "1995-01-01", "2001-08-01").agg(
        F.sum("payment_amount"), F.sum("quantity")).first()
    assert tuple(daily) == tuple(rowwise)
    assert daily[0] == Dec("-9828472.30")


def test_zero_and_null_quantity(spark):
    df = orders(spark, ("a", "2024-01-08", 1, 7, 0, "10.00", "shipped"), ("b", "2024-01-08", 2, 7, None, "10.00", "shipped"))
    assert rows(facts.f_daily_sales(df), "price", "quantity") == sorted([(None, 0), (None, None)], key=repr)


def test_unknown_status_is_not_a_sale(spark):
    df = orders(spark, *[(s, "2024-01-08", 1, 7, 1, "1.00", s) for s in ("shipped", "Refunded", None, "lost")])
    assert facts.f_sales(df, calendar(spark), "2024-01-08").count() == 1


def test_repeated_calendar_date_repeats_the_row(spark):
    df = orders(spark, ("a", "2024-01-08", 1, 7, 1, "1.00", "shipped"))
    assert facts.f_sales(df, calendar(spark, "2024-01-08", "2024-01-08"), "2024-01-08").count() == 2


def test_large_calendar_is_not_broadcast(spark, web):
    cal = calendar(spark, "2024-01-03", "2024-01-04")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = facts.left_join_calendar(web, cal)
        assert "SortMergeJoin LeftOuter" in plan_text(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(large) == rows(facts.left_join_calendar(web, cal))


def test_renamed_customer(spark):
    df = spark.createDataFrame([(1, "A", "Z", 5), (1, "B", "Y", 9)], "customer_id bigint, first_name string, last_name string, city_id int")
    assert rows(d_customer_full(df)) == [(1, "B", "Z", 9)]
    assert len(rows(d_customer_new(df, df.where("false").select("customer_id")))) == 2
