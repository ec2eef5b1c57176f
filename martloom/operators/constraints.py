"""Checks of the constraints the tables declare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.schemas import TABLES, TableSpec


def check_primary_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their number of rows."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(
        (F.col("row_count") > 1) | has_null
    )


def check_foreign_key(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, unknown_keys: Sequence = ()
) -> DataFrame:
    """Distinct child keys without a parent; NULL and the unknown members pass.

    The child is reduced to distinct keys before the join, so a hot key is one row there.
    """
    keys = child.select(column).where(F.col(column).isNotNull())
    if unknown_keys:
        keys = keys.where(~F.col(column).isin(*unknown_keys))
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return keys.distinct().join(parents, F.col(column) == F.col("_parent"), "left_anti")


def count_rows(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One row per (constraint, column) with its number of violations, from one scan."""
    if not checks:
        return df.sparkSession.createDataFrame([], "constraint_name string, column_name string, bad_rows bigint")
    one_row = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(checks)])
    return one_row.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("constraint_name"), F.lit(column).alias("column_name"),
            F.col(f"_{i}").alias("bad_rows"),
        )
        for i, (name, column, _) in enumerate(checks)
    ])))


def not_null_checks(columns: Sequence[str]):
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def varchar_checks(limits: Mapping[str, int]):
    return [("varchar", c, F.length(c) > n) for c, n in limits.items()]


def decimal_checks(types: Mapping[str, T.DecimalType]):
    # by comparison: a cast that overflows costs an error per row
    return [
        ("decimal", c, F.abs(F.round(F.col(c), t.scale)) >= F.lit(Decimal(10) ** (t.precision - t.scale)))
        for c, t in types.items()
    ]


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_rows(df, not_null_checks(columns))


def check_varchar_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return count_rows(df, varchar_checks(limits))


def check_decimal_range(df: DataFrame, types: Mapping[str, T.DecimalType]) -> DataFrame:
    """Values that overflow the declared decimal (extra digits are rounded, not counted)."""
    return count_rows(df, decimal_checks(types))


def check_table(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """All row-level constraints a table declares (NOT NULL, length, range) in one scan."""
    spec = TABLES[table] if isinstance(table, str) else table
    present = set(df.columns)
    required = [c for c in dict.fromkeys((*spec.primary_key, *spec.not_null)) if c in present]
    return count_rows(df, [
        *not_null_checks(required),
        *varchar_checks({c: n for c, n in spec.varchar.items() if c in present}),
        *decimal_checks({c: t for c, t in spec.decimals.items() if c in present}),
    ])
