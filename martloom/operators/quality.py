"""Data-quality rules: all rules of a table are one aggregate over one scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from martloom.functions import as_date, is_test_text


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``bad(column)`` is true."""

    table_name: str
    check_name: str
    column: str
    bad: Callable[[str], Column]

    def broken(self) -> Column:
        return self.bad(self.column)


def is_null(column: str) -> Column:
    return F.col(column).isNull()


# Table and check names as they are stored with the results.
ORDERS_CUSTOMER_NULL = Rule("user_order_log", "check_customer_id", "customer_id", is_null)
ORDERS_TEST_STATUS = Rule("user_order_log", "check_test_data", "status", is_test_text)
ORDERS_TEST_ITEM = Rule("user_order_log", "check_test_item", "item_name", is_test_text)
ACTIVITY_CUSTOMER_NULL = Rule("user_activity_log", "check_customer_id", "customer_id", is_null)
ACTIVITY_TEST_ACTION = Rule("user_activity_log", "check_test_data", "action", is_test_text)

ORDER_RULES = (ORDERS_CUSTOMER_NULL, ORDERS_TEST_STATUS, ORDERS_TEST_ITEM)
ACTIVITY_RULES = (ACTIVITY_CUSTOMER_NULL, ACTIVITY_TEST_ACTION)

FILES_TABLE, FILES_CHECK = "all_files", "file_sensor"


class QualityError(ValueError):
    """At least one check failed; ``results`` holds all result rows."""

    def __init__(self, message: str, results: Sequence[Row]):
        super().__init__(message)
        self.results = list(results)


def _ran(df: DataFrame, rules: Iterable[Rule]) -> list[Rule]:
    return [r for r in rules if r.column in df.columns]


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of rows that break it, from one scan.

    A rule whose column the table does not have is skipped: its number is NULL.
    """
    ran = _ran(df, rules)
    counts = {r: f"_{i}" for i, r in enumerate(ran)}
    one_row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(r.broken()).alias(n) for r, n in counts.items()]
    )
    result = F.array(*[
        F.struct(
            F.lit(r.table_name).alias("table_name"),
            F.lit(r.check_name).alias("check_name"),
            (F.col(counts[r]) if r in counts else F.lit(None)).cast("bigint").alias("bad_rows"),
        )
        for r in rules
    ])
    return one_row.select(F.inline(result))


def check_rules(df: DataFrame, rules: Sequence[Rule], check_date: dt.date | str) -> DataFrame:
    """Result rows: 0 passed, 1 failed, NULL skipped."""
    bad = F.col("bad_rows")
    return violations(df, rules).select(
        "table_name", "check_name",
        F.lit(as_date(check_date)).alias("check_date"),
        F.when(bad > 0, 1).when(bad == 0, 0).alias("check_result"),
    )


def files_check(availability: DataFrame, check_date: dt.date | str) -> DataFrame:
    """The file rule as one result row: failed when any expected increment is missing."""
    return availability.agg(F.coalesce(F.max("check_result"), F.lit(1)).alias("check_result")).select(
        F.lit(FILES_TABLE).alias("table_name"),
        F.lit(FILES_CHECK).alias("check_name"),
        F.lit(as_date(check_date)).alias("check_date"),
        F.col("check_result").cast("int").alias("check_result"),
    )


def gate(results: DataFrame, log: Callable[[Sequence[Row]], None] | None = None) -> list[Row]:
    """Log the result rows, then raise QualityError if one of them failed.

    Only the result rows (one per rule) come to the driver.
    """
    rows = results.collect()
    if log is not None:
        log(rows)
    failed = [f"{r['table_name']}.{r['check_name']}" for r in rows if r["check_result"] == 1]
    if failed:
        raise QualityError("checks failed: " + ", ".join(failed), rows)
    return rows


def block_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with the list of checks they break)."""
    ran = _ran(df, rules)
    # a rule that cannot tell (NULL) does not block a row
    broken = F.coalesce(reduce(lambda a, b: a | b, [r.broken() for r in ran], F.lit(False)), F.lit(False))
    reasons = F.array_compact(F.array(*[F.when(r.broken(), F.lit(f"{r.check_name}:{r.column}")) for r in ran]))
    return df.where(~broken), df.where(broken).withColumn("broken_checks", reasons)
