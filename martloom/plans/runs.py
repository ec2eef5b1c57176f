"""The runs a user starts: full rebuild, daily increment, back-fill.

Each step reads stored tables, so nothing is computed twice and a lost executor costs at
most its own tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import SHIPPED, as_date, previous_week, week_start
from martloom.operators import dimensions as dims
from martloom.operators import facts
from martloom.operators.cleaning import dedup_if_keyed, drop_if_present
from martloom.operators.keys import surrogate_ids
from martloom.plans import manifest
from martloom.plans.enforce import enforced, overwrite_enforced, replace_enforced
from martloom.operators.quality import (
    ACTIVITY_RULES, ORDER_RULES, block_rows, check_rules, files_check, gate,
)
from martloom.schemas import TABLES, conform
from martloom.session import materialise
from martloom.sources.csv_files import FILE, POSITION, read_full_csv, read_increment_csv
from martloom.sources.landing import Landing, increments_available
from martloom.sources.warehouse import Warehouse, replace_partitions

FULL_DATASETS = ("customer_research", "user_order_log", "user_activity_log")
# emptied before a rebuild, facts before the dimensions they refer to
REBUILT = (
    "staging.customer_research", "staging.user_order_log", "staging.user_activity_log",
    "mart.f_activity", "mart.f_daily_sales", "mart.f_research",
    "mart.d_calendar", "mart.d_customer", "mart.d_item", "mart.d_city", "mart.d_category",
)
# dimensions whose keys the facts refer to
INDEXED = ("mart.d_calendar", "mart.d_customer", "mart.d_item")
RULES = {"user_order_log": ORDER_RULES, "user_activity_log": ACTIVITY_RULES}
DATASETS = ("customer_research", "user_order_log", "user_activity_log", "price_log")


def _stage(name: str) -> str:
    return f"staging.{name}"


def run_full(
    spark: SparkSession, source_dir: str, root: str, load_date: dt.date | str, batch_id: int | None = None,
    bad_rows: str = "stop", multiline: bool = False, staged: Callable[[], None] | None = None,
) -> Warehouse:
    """Reload the three whole-history extracts and rebuild dimensions and facts from them.

    Rows that break a declared constraint of the mart stop the run; ``bad_rows="quarantine"`` sets them aside.
    ``multiline`` reads quoted line breaks. ``staged`` is called once all rows are in staging: nothing reads the extracts after that.
    """
    known_choice(bad_rows)
    wh = Warehouse(spark, root)
    load_date = as_date(load_date)
    day = F.lit(load_date)
    # whole-history extracts carry no status, so they add nothing to the signed daily sales
    wh.create_tables([*REBUILT, "mart.daily_sales_part", "mart.f_daily_sales_signed"])
    wh.create_tables(if_absent=True)

    def stage(name: str) -> None:
        rows = read_full_csv(spark, f"{source_dir.rstrip('/')}/{name}.csv", name, multiline=multiline)
        wh.overwrite(_stage(name), rows.withColumn("load_date", day), batch_id, spread=False)

    side_by_side([partial(stage, name) for name in FULL_DATASETS])
    if staged is not None:
        staged()

    orders = wh.read("staging.user_order_log")
    activity = wh.read("staging.user_activity_log")
    research = wh.read("staging.customer_research")

    def dimension(table: str, rows: DataFrame, order: Sequence[str]) -> None:
        rows = enforced(wh, table, materialise(rows), load_date, bad_rows, stored=False)
        if TABLES[table].serial:
            rows = surrogate_ids(rows, order)
        wh.overwrite(table, rows, batch_id)
        if table in INDEXED:
            wh.keys(table).replace(wh.read(table))

    def fact(table: str, rows: DataFrame) -> None:
        overwrite_enforced(wh, table, rows, load_date, bad_rows, batch_id)

    side_by_side([
        partial(dimension, "mart.d_calendar", dims.d_calendar(orders, activity, research), ["date_id"]),
        partial(dimension, "mart.d_customer", dims.d_customer_full(orders), ["customer_id"]),
        partial(dimension, "mart.d_item", dims.d_item_full(orders), ["item_id", "item_name"]),
        partial(dimension, "mart.d_city", dims.d_city_full(orders), ["city_id", "city_name"]),
        partial(dimension, "mart.d_category", dims.d_category(research), ["category_id"]),
        partial(manifest.rebuild, wh),
    ])
    side_by_side([
        partial(fact, "mart.f_activity", facts.f_activity(activity)),
        partial(fact, "mart.f_daily_sales", facts.f_daily_sales(orders)),
        partial(fact, "mart.f_research", facts.f_research(research)),
    ])
    return wh


def clean_increment(rows: DataFrame, dataset: str) -> DataFrame:
    """Row cleaning of one dataset: drop source ids, first row per key and file, status."""
    rows = drop_if_present(rows, "id")
    if dataset in ("user_order_log", "user_activity_log"):
        rows = dedup_if_keyed(rows, "uniq_id", [POSITION], within=[FILE])
    return rows


def side_by_side(loads: Sequence[Callable[[], None]]) -> None:
    """Run independent loads at the same time, so that small ones do not leave executors idle."""
    with ThreadPoolExecutor(len(loads)) as pool:
        for load in [pool.submit(f) for f in loads]:
            load.result()


def quarantine_path(wh: Warehouse, name: str) -> str:
    return wh.path(f"quarantine.{name}")


def read_quarantine(wh: Warehouse, name: str) -> DataFrame:
    """Blocked rows of a dataset with the checks they break."""
    schema = T.StructType([*TABLES[_stage(name)].schema, T.StructField("broken_checks", T.ArrayType(T.StringType()))])
    return wh.spark.read.schema(schema).parquet(quarantine_path(wh, name))


def known_choice(bad_rows: str) -> None:
    if bad_rows not in ("stop", "quarantine"):
        raise ValueError(f"bad_rows must be 'stop' or 'quarantine', not {bad_rows!r}")


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The warehouse with all its tables; manifest and key indexes are made where only older tables are there."""
    wh = Warehouse(spark, root)
    listed = wh.exists(manifest.TABLE)
    wh.create_tables(if_absent=True)
    if not listed:
        manifest.rebuild(wh)
    side_by_side([partial(wh.indexed_keys, table) for table in INDEXED])
    return wh


def _stage_increments(
    wh: Warehouse, landing: Landing, days: Sequence[dt.date], batch_id: int | None, bad_rows: str, multiline: bool
) -> None:
    labels = [d.isoformat() for d in days]

    def load(name: str) -> None:
        absent = {"status": SHIPPED} if name == "user_order_log" else None
        rows = read_increment_csv(wh.spark, landing, name, labels, defaults=absent, multiline=multiline)
        rows = clean_increment(rows, name).withColumn("load_date", F.col("increment").cast("date"))
        rows = conform(rows, _stage(name))
        if bad_rows == "quarantine" and name in RULES:
            rows, blocked = block_rows(rows, RULES[name])
            replace_partitions(blocked, quarantine_path(wh, name), "load_date", days)
        wh.replace(_stage(name), rows, days, batch_id)

    side_by_side([partial(load, name) for name in DATASETS])


def _check(
    wh: Warehouse, days: Sequence[dt.date], check_date: dt.date, whole_table: bool, bad_rows: str, datasets: Sequence[str],
) -> None:
    checked = []
    for name in datasets:
        rules = RULES[name]
        if bad_rows == "quarantine":
            rows = read_quarantine(wh, name).where(F.col("load_date").isin(*days))
        else:
            rows = wh.read(_stage(name))
            if not whole_table:
                rows = rows.where(F.col("load_date").isin(*days))
        checked.append(check_rules(rows, rules, check_date))
    # all results are logged before the first failure stops the run
    results = reduce(DataFrame.unionByName, checked)
    if bad_rows == "quarantine":
        wh.log_checks(results.collect())
    else:
        gate(results, wh.log_checks)


def _add_dimension_rows(wh: Warehouse, days: Sequence[dt.date], batch_id, check_date: dt.date, bad_rows: str) -> None:
    def staged(name: str) -> DataFrame:
        return wh.read(_stage(name)).where(F.col("load_date").isin(*days))

    orders = staged("user_order_log")
    dates = dims.d_calendar(orders, staged("user_activity_log"), staged("customer_research"))

    def added(table: str, new: DataFrame, order: Sequence[str]) -> None:
        rows = enforced(wh, table, materialise(new), check_date, bad_rows)
        if TABLES[table].serial:
            rows = surrogate_ids(rows, order, existing=wh.read(table))
        rows = materialise(rows)
        wh.append(table, rows, batch_id)
        if table in INDEXED:
            wh.keys(table).add(rows)

    def calendar() -> None:
        added("mart.d_calendar", wh.keys("mart.d_calendar").unknown(dates), ["date_id"])

    def dimension(table: str, operator: Callable, order: Sequence[str]) -> None:
        added(table, operator(orders, wh.read(table)), order)

    side_by_side([
        calendar,
        partial(dimension, "mart.d_customer", dims.d_customer_new, ["customer_id", "first_name", "last_name"]),
        partial(dimension, "mart.d_item", dims.d_item_new, ["item_id", "item_name"]),
        partial(dimension, "mart.d_city", dims.d_city_new, ["city_id", "city_name"]),
    ])


def _add_parts(wh: Warehouse, days: Sequence[dt.date], batch_id) -> None:
    """What the loads ``days`` add to the signed daily sales; a repeated load replaces its parts."""
    orders = wh.read(_stage("user_order_log")).where(F.col("load_date").isin(*days))
    wh.replace("mart.daily_sales_part", facts.daily_sales_parts(orders, "load_date"), days, batch_id)


def _merge_daily_sales(wh: Warehouse, touched: set[dt.date], batch_id) -> None:
    """Signed daily sales of all touched dates from the parts of the loads.

    A late row changes its date by the part it comes with; orders of other loads are not read again.
    """
    parts = manifest.staged(wh, "user_order_log", touched, "mart.daily_sales_part")
    merged = facts.merged_daily_sales(parts.where(F.col("sale_date").isin(*touched)))
    wh.replace("mart.f_daily_sales_signed", merged, touched, batch_id)


def settle(
    wh: Warehouse, days: Sequence[dt.date], check_date: dt.date, whole_table_checks: bool, bad_rows: str, batch_id,
    datasets: Sequence[str] = tuple(RULES),
) -> None:
    """What follows a staging load: its manifest and quality gate, then dimension rows and daily parts."""
    side_by_side([
        partial(manifest.record, wh, days), partial(_check, wh, days, check_date, whole_table_checks, bad_rows, datasets)])
    side_by_side([
        partial(_add_dimension_rows, wh, days, batch_id, check_date, bad_rows), partial(_add_parts, wh, days, batch_id)])


def run_backfill(
    spark: SparkSession, landing: Landing, root: str, first: dt.date | str, last: dt.date | str,
    batch_id: int | None = None, check_date: dt.date | str | None = None, whole_table_checks: bool = False,
    bad_rows: str = "stop", multiline: bool = False,
) -> Warehouse:
    """Load the increments first..last, check them, and bring dimensions and marts up to date.

    One job per table, whatever the number of dates. Sales of every business date that occurs
    in the loaded rows are written again from all staged rows of that date, and likewise the
    retention of every touched week, so late rows repair the dates they belong to. A repeated
    run gives the same tables.
    """
    known_choice(bad_rows)
    wh = open_warehouse(spark, root)
    first, last = as_date(first), as_date(last)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    check_date = as_date(check_date or last)

    available = increments_available(spark, landing, [d.isoformat() for d in days], DATASETS)
    gate(files_check(available, check_date), wh.log_checks)

    # a repeated load may no longer hold dates its first version had
    touched = manifest.business_dates(wh, "user_order_log", days)
    _stage_increments(wh, landing, days, batch_id, bad_rows, multiline)
    settle(wh, days, check_date, whole_table_checks, bad_rows, batch_id)
    touched |= manifest.business_dates(wh, "user_order_log", days)
    refresh_marts(wh, touched | set(days), check_date, batch_id, bad_rows)
    return wh


def refresh_marts(
    wh: Warehouse, sale_dates: set[dt.date], check_date: dt.date, batch_id: int | None = None, bad_rows: str = "stop",
) -> None:
    """Sales and retention of the given business dates and their weeks, from the loads that hold them."""
    def sales() -> None:
        orders = manifest.staged(wh, "user_order_log", sale_dates)
        rows = facts.f_sales_backfill(
            orders.where(F.col("date_time").cast("date").isin(*sale_dates)),
            wh.read("mart.d_calendar"), min(sale_dates), max(sale_dates))
        replace_enforced(wh, "mart.f_sales", rows, check_date, sale_dates, bad_rows, batch_id)

    def retention() -> None:
        weeks = {d - dt.timedelta(days=d.weekday()) for d in sale_dates}
        orders = manifest.staged(wh, "user_order_log", [w + dt.timedelta(days=i) for w in weeks for i in range(7)])
        rows = facts.retention_backfill(orders.where(week_start("date_time").isin(*weeks)), min(weeks), max(weeks))
        wh.replace("mart.f_customer_retention", rows, weeks, batch_id)

    side_by_side([sales, retention, partial(_merge_daily_sales, wh, sale_dates, batch_id)])


def run_increment(
    spark: SparkSession, landing: Landing, root: str, ds: dt.date | str,
    batch_id: int | None = None, whole_table_checks: bool = True, bad_rows: str = "stop", multiline: bool = False,
) -> Warehouse:
    """Daily run for the business date ``ds``.

    Files there → staged by load date → quality gate → new dimension rows → signed sales of
    ``ds`` → retention of the week before ``ds`` → signed daily sales of every date the increment touches. The checks cover the whole staging tables by
    default, which is a scan of three columns of all history; ``whole_table_checks=False``
    limits them to this increment. A broken check stops the run with the rows staged;
    ``bad_rows="quarantine"`` keeps those rows out of staging instead and goes on.
    """
    known_choice(bad_rows)
    wh = open_warehouse(spark, root)
    ds = as_date(ds)
    available = increments_available(spark, landing, [ds.isoformat()], DATASETS)
    gate(files_check(available, ds), wh.log_checks)

    touched = manifest.business_dates(wh, "user_order_log", [ds])
    _stage_increments(wh, landing, [ds], batch_id, bad_rows, multiline)
    settle(wh, [ds], ds, whole_table_checks, bad_rows, batch_id)
    touched |= manifest.business_dates(wh, "user_order_log", [ds]) | {ds}

    def sales() -> None:
        orders = manifest.staged(wh, "user_order_log", [ds])
        rows = facts.f_sales(orders, wh.read("mart.d_calendar"), ds).withColumn("sale_date", F.lit(ds))
        replace_enforced(wh, "mart.f_sales", rows, ds, [ds], bad_rows, batch_id)

    def retention() -> None:
        week = previous_week(ds)[0]
        orders = manifest.staged(wh, "user_order_log", [week + dt.timedelta(days=i) for i in range(7)])
        rows = facts.f_customer_retention(orders, ds).withColumn("week_start", F.lit(week))
        wh.replace("mart.f_customer_retention", rows, [week], batch_id)

    side_by_side([sales, retention, partial(_merge_daily_sales, wh, touched, batch_id)])
    return wh
