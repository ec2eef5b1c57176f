"""Column functions shared by the dimensions, facts and quality rules.

All of them are compositions of built-in functions, so they stay inside
whole-stage code generation. No function reads the clock: the current date is
always an argument (``as_of`` or ``ds``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "SHIPPED", "REFUNDED", "UNKNOWN_KEY", "PERIOD_WEEKLY", "CATEGORY_PREFIX", "TEST_MARK",
    "as_date", "as_timestamp_ntz", "timestamp_to_date", "date_key", "day_num", "month_num",
    "year_num", "month_name", "iso_week", "week_start", "previous_week",
    "previous_week_filter", "business_date_filter", "date_range_filter", "status_filter",
    "refund_sign", "safe_ratio", "label_concat", "is_test_text", "null_spread",
]

# They appear in stored results and must not change.
SHIPPED = "shipped"
REFUNDED = "refunded"
UNKNOWN_KEY = 0
PERIOD_WEEKLY = "weekly"
CATEGORY_PREFIX = "category_"
TEST_MARK = "test"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def as_timestamp_ntz(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def timestamp_to_date(c: Column | str) -> Column:
    return _col(c).cast("date")


def date_key(c: Column | str) -> Column:
    """Integer YYYYMMDD, by arithmetic so that no string is built per row."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def day_num(c: Column | str) -> Column:
    return F.dayofmonth(_col(c))


def month_num(c: Column | str) -> Column:
    return F.month(_col(c))


def year_num(c: Column | str) -> Column:
    return F.year(_col(c))


def month_name(c: Column | str) -> Column:
    """Abbreviated English month: Jan, Feb, …"""
    return F.date_format(_col(c), "MMM")


def iso_week(c: Column | str) -> Column:
    """ISO 8601 week number (2021-01-03 is in week 53, 2024-12-30 in week 1)."""
    return F.weekofyear(_col(c))


def week_start(c: Column | str) -> Column:
    """Monday of the week a timestamp falls in (date arithmetic: no session time zone)."""
    day = _col(c).cast("date")
    return F.date_sub(day, F.weekday(day))


def previous_week(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    """Half-open [Monday, next Monday) of the week before the one holding ``as_of``."""
    day = as_date(as_of)
    this_monday = day - dt.timedelta(days=day.weekday())
    return this_monday - dt.timedelta(days=7), this_monday


def previous_week_filter(c: Column | str, as_of: dt.date | str) -> Column:
    """Literal bounds on the raw timestamp, so the range reaches the Parquet scan."""
    start, end = previous_week(as_of)
    return date_range_filter(c, start, end)


def business_date_filter(c: Column | str, ds: dt.date | str) -> Column:
    """Rows of one calendar day."""
    day = as_date(ds)
    return date_range_filter(c, day, day + dt.timedelta(days=1))


def date_range_filter(c: Column | str, start: dt.date, end: dt.date) -> Column:
    """``start <= c < end`` as timestamps without time zone."""
    c = _col(c)
    return (c >= as_timestamp_ntz(start)) & (c < as_timestamp_ntz(end))


def status_filter(c: Column | str) -> Column:
    """Only the two known statuses; case-sensitive, NULL is not kept."""
    return _col(c).isin(SHIPPED, REFUNDED)


def refund_sign(amount: Column | str, status: Column | str) -> Column:
    """Refunded amounts count negative."""
    amount, status = _col(amount), _col(status)
    return F.when(status == REFUNDED, -amount).otherwise(amount)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def label_concat(c: Column | str) -> Column:
    """``category_<id>``; NULL stays NULL."""
    return F.concat(F.lit(CATEGORY_PREFIX), _col(c).cast("string"))


def is_test_text(c: Column | str) -> Column:
    """True where the text holds ``test`` anywhere, in any case; NULL is no match."""
    return F.lower(F.coalesce(_col(c), F.lit(""))).contains(TEST_MARK)


NULL_SPREAD = 1024


def null_spread(key: Column | str, *columns: str) -> Column:
    """0 for a key, one of 1024 numbers for a NULL key, fixed by the other columns.

    Added to the keys of an anti join it sends rows without a key, which match nothing, to
    many tasks instead of one.
    """
    spread = F.pmod(F.xxhash64(*columns), F.lit(NULL_SPREAD))
    return F.when(_col(key).isNull(), spread).otherwise(F.lit(0)).cast("bigint")
