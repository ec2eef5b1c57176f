"""Fact tables and the weekly retention mart.

Money stays in the wide decimal type Spark sums into; the column types of the tables are
applied on write, where a value that does not fit stops the load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import (
    PERIOD_WEEKLY, REFUNDED, UNKNOWN_KEY, as_date, as_timestamp_ntz, business_date_filter, date_key,
    date_range_filter, iso_week, previous_week, previous_week_filter, refund_sign, safe_ratio,
    status_filter, week_start,
)

MONEY = "decimal(24,2)"


def f_activity(activity: DataFrame) -> DataFrame:
    return activity.groupBy(
        F.col("action_id").alias("activity_id"), date_key("date_time").alias("date_id")
    ).agg(F.sum("quantity").alias("click_number"))


def _price(payment: str, quantity: str):
    return safe_ratio(F.sum(payment), F.sum(quantity)).cast(MONEY).alias("price")


def f_daily_sales(orders: DataFrame) -> DataFrame:
    """Per day, item and customer; refunds are not netted here."""
    return orders.groupBy(date_key("date_time").alias("date_id"), "item_id", "customer_id").agg(
        _price("payment_amount", "quantity"),
        F.sum("quantity").alias("quantity"),
        F.sum("payment_amount").cast(MONEY).alias("payment_amount"),
    )


def f_research(research: DataFrame) -> DataFrame:
    sums = research.groupBy(date_key("date_id").alias("date_id"), "category_id", "geo_id").agg(
        F.sum("sales_qty").alias("quantity"), F.sum("sales_amt").cast(MONEY).alias("amount")
    )
    return sums.select(
        "date_id", "category_id", "geo_id",
        F.lit(UNKNOWN_KEY).alias("customer_id"), F.lit(UNKNOWN_KEY).alias("item_id"),
        "quantity", "amount",
    )


def left_join_calendar(rows: DataFrame, calendar: DataFrame, timestamp: str = "date_time") -> DataFrame:
    """Add ``date_id``; a date the calendar lacks keeps its row with a NULL id.

    Only two fixed-width calendar columns take part; Spark broadcasts them or not by the size it finds.
    """
    days = calendar.select("date_id", "fact_date")
    joined = rows.join(days, F.col(timestamp).cast("date") == F.col("fact_date"), "left")
    return joined.select("date_id", *rows.columns)


def _signed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "quantity": refund_sign("quantity", "status"),
        "payment_amount": refund_sign("payment_amount", "status"),
    })


def _sales(rows: DataFrame, calendar: DataFrame, *extra) -> DataFrame:
    needed = ["date_time", "item_id", "customer_id", "city_id", "quantity", "payment_amount", "status"]
    known = rows.where(status_filter("status")).select(*needed)
    return left_join_calendar(_signed(known), calendar).select(
        "date_id", "item_id", "customer_id", "city_id", "quantity", "payment_amount", *extra
    )


def f_sales(orders: DataFrame, calendar: DataFrame, ds: dt.date | str) -> DataFrame:
    """Row-level signed sales of one business date."""
    return _sales(orders.where(business_date_filter("date_time", ds)), calendar)


def f_sales_backfill(
    orders: DataFrame, calendar: DataFrame, first: dt.date | str, last: dt.date | str
) -> DataFrame:
    """``f_sales`` of all dates first..last (inclusive) in one job, with ``sale_date``."""
    end = as_date(last) + dt.timedelta(days=1)
    rows = orders.where(date_range_filter("date_time", as_date(first), end))
    return _sales(rows, calendar, F.col("date_time").cast("date").alias("sale_date"))


def f_daily_sales_signed(orders: DataFrame) -> DataFrame:
    """Per day, item, customer and status with refunds negative; the price is positive."""
    keys = [date_key("date_time").alias("date_id"), "item_id", "customer_id", "status"]
    sums = orders.where(status_filter("status")).groupBy(*keys).agg(
        _price("payment_amount", "quantity"),
        F.sum("quantity").alias("quantity"),
        F.sum("payment_amount").cast(MONEY).alias("payment_amount"),
    )
    # status is part of the group, so the sign can be put on the sums
    return _signed(sums)


def daily_sales_parts(orders: DataFrame, *loads: str) -> DataFrame:
    """Unsigned sums per business date, item, customer and status: what each load adds to the daily sales.

    ``loads`` are the columns that name the load; parts of several loads merge into ``merged_daily_sales``.
    """
    known = orders.where(status_filter("status") & F.col("date_time").isNotNull())
    return known.groupBy(F.col("date_time").cast("date").alias("sale_date"), "item_id", "customer_id", "status", *loads).agg(
        F.sum("quantity").alias("quantity"), F.sum("payment_amount").cast(MONEY).alias("payment_amount"))


def merged_daily_sales(parts: DataFrame) -> DataFrame:
    """``f_daily_sales_signed`` from the parts of all loads of a date, with ``sale_date``."""
    sums = parts.groupBy(date_key("sale_date").alias("date_id"), "item_id", "customer_id", "status", "sale_date").agg(
        _price("payment_amount", "quantity"),
        F.sum("quantity").alias("quantity"),
        F.sum("payment_amount").cast(MONEY).alias("payment_amount"),
    )
    return _signed(sums)


def _retention(orders: DataFrame, extra_keys: list, signed: bool) -> DataFrame:
    amount = refund_sign("payment_amount", "status") if signed else F.col("payment_amount")
    extra = ["week_start"] if extra_keys else []
    buyers = orders.groupBy(*extra_keys, "customer_id", "item_id").agg(
        F.count("uniq_id").alias("n_orders"),
        F.sum(amount).alias("paid"),
        F.count_if(F.col("status") == REFUNDED).alias("n_refunds"),
    )
    known = F.col("customer_id").isNotNull()
    new, returning = F.col("n_orders") == 1, F.col("n_orders") > 1

    def paid_by(group):
        # NULL only where every buyer is in the group and none of them has an amount
        return F.sum(F.when(group, F.col("paid")).otherwise(0)).cast(MONEY)

    return buyers.groupBy(*extra, "item_id").agg(
        F.count_if(known & new).alias("new_customers_count"),
        F.count_if(known & returning).alias("returning_customers_count"),
        F.count_if(known & (F.col("n_refunds") > 0)).alias("refunded_customer_count"),
        paid_by(new).alias("new_customers_revenue"),
        paid_by(returning).alias("returning_customers_revenue"),
        F.sum("n_refunds").alias("customers_refunded"),
    )


_RETENTION_COLUMNS = [
    "new_customers_count", "returning_customers_count", "refunded_customer_count", "period_name",
    "period_id", "item_id", "new_customers_revenue", "returning_customers_revenue",
    "customers_refunded",
]


def _labelled(metrics: DataFrame, period_id, *extra: str) -> DataFrame:
    return metrics.withColumns({
        "period_name": F.lit(PERIOD_WEEKLY), "period_id": period_id,
    }).select(*_RETENTION_COLUMNS, *extra)


def _label_days(label: str) -> int:
    if label not in ("run_week", "data_week"):
        raise ValueError(f"label must be 'run_week' or 'data_week', not {label!r}")
    return 7 if label == "run_week" else 0


def f_customer_retention(
    orders: DataFrame, as_of: dt.date | str, label: str = "run_week", signed: bool = False
) -> DataFrame:
    """Per item, the week before ``as_of``: customers with exactly one order (new), with more
    (returning) and with refunds, and their revenues.

    The period is labelled with the week of ``as_of`` by default; ``label="data_week"`` takes
    the week of the data. Revenue counts refunds as positive unless ``signed``. A row without
    ``uniq_id`` adds no order, and rows without a customer add revenue and refunds only.
    """
    start, _ = previous_week(as_of)
    metrics = _retention(orders.where(previous_week_filter("date_time", as_of)), [], signed)
    period = F.lit(start + dt.timedelta(days=_label_days(label)))
    return _labelled(metrics, iso_week(period))


def _monday(day: dt.date | str) -> dt.date:
    day = as_date(day)
    return day - dt.timedelta(days=day.weekday())


def retention_backfill(
    orders: DataFrame, first: dt.date | str | None = None, last: dt.date | str | None = None,
    label: str = "run_week", signed: bool = False,
) -> DataFrame:
    """``f_customer_retention`` of every data week in one job, with ``week_start``.

    ``first`` and ``last`` limit the data weeks (any day of the week will do).
    """
    if first is not None:
        orders = orders.where(F.col("date_time") >= as_timestamp_ntz(_monday(first)))
    if last is not None:
        end = _monday(last) + dt.timedelta(days=7)
        orders = orders.where(F.col("date_time") < as_timestamp_ntz(end))
    orders = orders.where(F.col("date_time").isNotNull())
    metrics = _retention(orders, [week_start("date_time").alias("week_start")], signed)
    period = F.date_add("week_start", _label_days(label))
    return _labelled(metrics, iso_week(period), "week_start")
