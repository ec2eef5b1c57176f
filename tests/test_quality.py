import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators import constraints as c
from martloom.operators import quality as q
from martloom.schemas import TABLES, conform
from martloom.sources.warehouse import Warehouse
from martloom.session import scratch_path
from tests.conftest import plan_text, rows

DAY = dt.date(2024, 1, 31)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(1, "ball", "shipped"), (None, "latest", None), (2, "ball", "Test")], "customer_id bigint, item_name string, status string")


def test_rules(orders):
    assert rows(q.violations(orders, q.ORDER_RULES), "check_name", "bad_rows") == [
        ("check_customer_id", 1), ("check_test_data", 1), ("check_test_item", 1)]
    assert rows(q.check_rules(orders.where("customer_id = 1"), q.ORDER_RULES, DAY), "check_result") == [(0,)] * 3


def test_rule_without_its_column_is_skipped(orders):
    got = q.check_rules(orders.drop("status"), q.ORDER_RULES, DAY)
    assert {r["check_name"]: r["check_result"] for r in got.collect()} == {
        "check_customer_id": 1, "check_test_data": None, "check_test_item": 1}
    only = q.check_rules(orders.drop("status"), [q.ORDERS_TEST_STATUS], DAY)
    assert rows(only) == [("user_order_log", "check_test_data", DAY, None)]


def test_empty_table_passes(orders):
    assert rows(q.check_rules(orders.where("false"), q.ORDER_RULES, DAY), "check_result") == [(0,)] * 3


def test_gate_logs_then_raises(spark, orders):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.create_tables(["dq_checks_results"])
    with pytest.raises(q.QualityError, match="user_order_log.check_customer_id") as error:
        q.gate(q.check_rules(orders, q.ORDER_RULES, DAY), wh.log_checks)
    assert len(error.value.results) == 3
    assert rows(wh.read("dq_checks_results")) == [
        ("user_order_log", n, DAY, 1) for n in ("check_customer_id", "check_test_data", "check_test_item")]
    q.gate(q.check_rules(orders.where("customer_id = 1"), q.ORDER_RULES, DAY), wh.log_checks)
    assert wh.read("dq_checks_results").count() == 6


def test_one_scan_for_all_rules(spark, orders):
    path = scratch_path(spark, "scan")
    orders.write.parquet(path)
    plan = plan_text(q.check_rules(spark.read.parquet(path), q.ORDER_RULES, DAY), "simple")
    assert plan.count("FileScan") == 1


def test_block_rows_splits_without_loss(orders):
    accepted, blocked = q.block_rows(orders, q.ORDER_RULES)
    assert rows(accepted, "customer_id") == [(1,)]
    assert rows(blocked, "customer_id", "broken_checks") == [
        (2, ["check_test_data:status"]), (None, ["check_customer_id:customer_id", "check_test_item:item_name"])]
    assert q.block_rows(orders.select("item_name"), [q.ORDERS_TEST_STATUS])[1].count() == 0


def test_rule_that_cannot_tell_keeps_the_row(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "v int")
    accepted, blocked = q.block_rows(df, [q.Rule("t", "too_large", "v", lambda name: F.col(name) > 5)])
    assert rows(accepted) == [(None,), (1,)] or rows(accepted) == [(1,), (None,)]
    assert rows(blocked, "v") == [(9,)]


def test_primary_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    assert rows(c.check_primary_key(df, ["a", "b"])) == [(1, 1, 2), (None, 3, 1)]


def test_foreign_key(spark):
    child = spark.createDataFrame([(0,), (1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(c.check_foreign_key(child, "k", parent, "p", (0,))) == [(2,)]
    assert rows(c.check_foreign_key(child, "k", parent, "p")) == [(0,), (2,)]


def test_row_constraints_in_one_scan(spark):
    df = spark.createDataFrame(
        [("20240101", None, None, "Jan"), (None, None, None, "a long month")], "date_id string, fact_date date, day_num int, month_name string")
    got = {(r[0], r[1]): r[2] for r in c.check_table(df, "mart.d_calendar").collect()}
    assert got == {("not_null", "date_id"): 1, ("not_null", "fact_date"): 2, ("varchar", "month_name"): 1}


def test_decimal_range(spark):
    values = ["123456789012.000", "-100000000.000", "99999999.995", "99999999.994", "-99999999.99", None]
    df = spark.createDataFrame([(v and Dec(v),) for v in values], "v decimal(16,3)")
    assert rows(c.check_decimal_range(df, {"v": T.DecimalType(10, 2)})) == [("decimal", "v", 3)]
    assert df.where(df.v.try_cast("decimal(10,2)").isNull() & df.v.isNotNull()).count() == 3


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_conform_stops_on_overflow(spark, ansi):
    df = spark.createDataFrame([(1, 20240101, 2**31)], "activity_id bigint, date_id int, click_number bigint")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="click_number does not fit int"):
            conform(df, "mart.f_activity").collect()
        ok = conform(df.withColumn("click_number", df.activity_id), TABLES["mart.f_activity"])
        assert rows(ok) == [(1, 20240101, 1)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_conform_names_the_missing_column(spark):
    with pytest.raises(ValueError, match="fact_date"):
        conform(spark.range(1).toDF("date_id"), "mart.d_calendar")
