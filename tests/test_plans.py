"""The physical plans the library relies on at scale."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom import functions as fn
from martloom.operators import cleaning, constraints, dimensions, facts
from martloom.plans import inputs, manifest
from martloom.plans.catalog import QUERIES
from martloom.session import scratch_path
from martloom.sources.warehouse import Warehouse
from tests.conftest import DATA, plan_text, rows

EAGER = {"create_tables", "full_rebuild", "backfill_run"}  # small unions over many stored tables


@pytest.fixture(scope="module")
def staged(spark):
    path = scratch_path(spark, "orders")
    inputs.order_log(spark, DATA).write.parquet(path)
    return path


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def pushed(plan):
    return " ".join(line for line in plan.splitlines() if "PushedFilters" in line)


def read_columns(plan):
    return [line.split("struct<")[1] for line in plan.splitlines() if line.startswith("ReadSchema")]


def test_week_and_day_ranges_reach_the_scan(spark, staged):
    orders = spark.read.parquet(staged)
    for df in (
        facts.f_customer_retention(orders, "1999-05-12"),
        facts.f_sales(orders, spark.createDataFrame([], "date_id int, fact_date date"), "1999-05-01"),
        orders.where(fn.business_date_filter("date_time", "1999-05-01")),
    ):
        text = pushed(plan_text(df))
        assert "GreaterThanOrEqual(date_time" in text and "LessThan(date_time" in text


def test_only_needed_columns_are_read(spark, staged):
    (schema,) = read_columns(plan_text(facts.f_daily_sales(spark.read.parquet(staged))))
    assert schema.count(":") == 5
    (schema,) = read_columns(plan_text(dimensions.d_item_full(spark.read.parquet(staged))))
    assert schema.count(":") == 2


def test_aggregates_are_partial_first(spark, staged):
    orders = spark.read.parquet(staged)
    for df, exchanges in (
        (facts.f_daily_sales(orders), 1), (facts.f_daily_sales_signed(orders), 1),
        (facts.retention_backfill(orders), 2), (dimensions.d_customer_full(orders), 2),
    ):
        plan = plan_text(df, "simple")
        assert plan.count("Exchange hashpartitioning") == exchanges
        lowest_exchange = plan.rindex("Exchange hashpartitioning")
        assert "HashAggregate" in plan[lowest_exchange:], plan


def test_money_and_counts_stay_in_hash_aggregates(spark, staged):
    orders = spark.read.parquet(staged)
    for df in (facts.f_daily_sales(orders), facts.retention_backfill(orders), facts.f_daily_sales_signed(orders)):
        assert "SortAggregate" not in plan_text(df, "simple")


def test_new_dimension_rows_join_after_reduction(spark, staged, no_broadcast):
    orders = spark.read.parquet(staged)
    known = orders.where("item_id < 500").select("item_id")
    plan = plan_text(dimensions.d_item_new(orders, known), "simple")
    join = plan.index("SortMergeJoin")
    assert "LeftAnti" in plan and "HashAggregate" in plan[join:]
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_rows_without_key_are_spread(spark, staged, no_broadcast):
    orders = spark.read.parquet(staged)
    plan = plan_text(cleaning.dedup_against_history(orders, orders.where("quantity > 40")), "simple")
    exchange = [line for line in plan.splitlines() if "Exchange hashpartitioning(uniq_id" in line]
    assert exchange and "_spread" in exchange[0]


def test_hot_null_key_is_kept_whole(spark, no_broadcast):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("uniq_id"), F.col("id").alias("v"))
    seen = df.where("v < 300").select("uniq_id")
    assert cleaning.dedup_against_history(df, seen).count() == 3000 - 200


def test_foreign_keys_are_distinct_before_the_join(spark, staged, no_broadcast):
    orders = spark.read.parquet(staged)
    plan = plan_text(constraints.check_foreign_key(orders, "item_id", orders, "item_id"), "simple")
    assert "HashAggregate" in plan[plan.index("SortMergeJoin"):]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_no_python_no_single_task_window(spark, name):
    plan = plan_text(QUERIES[name](spark, "/root/testdata/sf0.001"), "simple")
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    if name not in ("surrogate_ids", "read_csv_multiline"):  # over one row per partition, and within byte ranges
        assert "Window [" not in plan


def test_weeks_do_not_depend_on_the_session_time_zone(spark):
    web = inputs.web_order_log(spark, DATA)
    utc = rows(facts.retention_backfill(web))
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert rows(facts.retention_backfill(web)) == utc
        assert rows(dimensions.d_calendar(web, web, web.withColumnRenamed("date_time", "date_id"))) == rows(
            dimensions.d_calendar(web, web, web.withColumnRenamed("date_time", "date_id")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_marts_open_only_the_loads_that_hold_their_dates(spark):
    """The manifest prunes the load partitions before a file is opened."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.create_tables()
    web = inputs.web_order_log(spark, DATA).withColumns({
        "city_id": F.lit(1), "city_name": F.lit("c"), "first_name": F.lit("a"), "last_name": F.lit("b"),
        "item_name": F.lit("i"), "load_date": F.col("date_time").cast("date")})
    wh.replace("staging.user_order_log", web)
    manifest.rebuild(wh)
    days = [dt.date(2024, 1, 9), dt.date(2024, 1, 10)]
    staged_rows = manifest.staged(wh, "user_order_log", days)
    sales = facts.f_sales_backfill(staged_rows, wh.read("mart.d_calendar"), *days)
    scan = [line for line in plan_text(sales).splitlines() if "PartitionFilters" in line and "load_date" in line]
    assert any("dynamicpruning" in line for line in scan)
    assert any("GreaterThanOrEqual(date_time" in line for line in plan_text(sales).splitlines() if "PushedFilters" in line)
    want = web.where(F.col("load_date").isin(*days)).count()
    assert staged_rows.count() == want > 0


@pytest.mark.parametrize("name", ["dedup_against_index", "read_increment_csv"])
def test_order_log_is_joined_once(spark, monkeypatch, name):
    """Steps that read the order log several times read rows that were written once."""
    seen, order_log = spark.sparkContext.accumulator(0), inputs.order_log

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def log(*args, **options):
        rows = order_log(*args, **options)
        return rows.mapInArrow(counted, rows.schema)

    monkeypatch.setattr(inputs, "order_log", log)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert seen.value == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_order_lines_are_shuffled_for_parts_and_orders_only(spark, no_broadcast):
    """Customers and nations meet the orders before the lines do, and lines meet parts while they are narrow."""
    plan = plan_text(inputs.order_log(spark, DATA), "extended")
    logical = plan[plan.index("Optimized Logical Plan"):plan.index("Physical Plan")]
    joins = [line for line in logical.splitlines() if "Join Inner" in line]
    # the tree is printed from the last join on: lines with orders, then each side's own joins
    assert "l_orderkey" in joins[0] and "o_orderkey" in joins[0]
    assert ["l_partkey" in j for j in joins[1:]] == [True, False, False]
