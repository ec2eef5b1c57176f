"""Declared constraints at the doors of the mart: only rows that keep them are written.

New rows meet the stored key index of their table (primary key) and of the tables they refer to (foreign keys);
no stored row is read for it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.operators import constraints
from martloom.operators.quality import QualityError
from martloom.schemas import TABLES, TableSpec
from martloom.sources.warehouse import Warehouse

BROKEN = "broken_constraints"


def _natural_key(spec: TableSpec) -> tuple[str, ...]:
    """The primary key, unless it is the number that the load itself gives."""
    return () if spec.serial in spec.primary_key else spec.primary_key


def repeated_keys(wh: Warehouse, table: str, rows: DataFrame, stored: bool) -> DataFrame:
    """Keys that several of the rows have, hold a NULL, or (``stored``) that the table has already."""
    key = list(_natural_key(TABLES[table]))
    repeated = constraints.check_primary_key(rows, key).select(*key)
    if stored:
        repeated = repeated.union(wh.keys(table).known(rows.select(*key)).distinct())
    return repeated.distinct()


def orphans(wh: Warehouse, table: str, rows: DataFrame) -> dict[str, DataFrame]:
    """Per foreign key column the distinct keys of the rows that the referred table does not have."""
    out = {}
    for fk in TABLES[table].foreign_keys:
        keys = wh.keys(fk.parent).read().select(fk.parent_column)
        out[fk.column] = constraints.check_foreign_key(rows, fk.column, keys, fk.parent_column, fk.unknown_keys)
    return out


def _broken_values(spec: TableSpec, columns: list[str]) -> list[tuple[str, str, Column]]:
    # key columns with a NULL are found as such; a serial number is given after the check
    required = [c for c in spec.not_null if c in columns and c != spec.serial]
    return [
        *constraints.not_null_checks(required),
        *constraints.varchar_checks({c: n for c, n in spec.varchar.items() if c in columns}),
        *constraints.decimal_checks({c: t for c, t in spec.decimals.items() if c in columns}),
    ]


def violations(wh: Warehouse, table: str, rows: DataFrame, stored: bool = True, keyed: bool = True) -> list[Row]:
    """(constraint, bad) of all broken constraints, from one job: at most one row per constraint.

    ``keyed=False`` leaves out the primary key.
    """
    spec = TABLES[table]
    counts = []
    if keyed and _natural_key(spec):
        name = "primary_key:" + ",".join(_natural_key(spec))
        counts.append(repeated_keys(wh, table, rows, stored).agg(F.count(F.lit(1)).alias("bad")).select(
            F.lit(name).alias("constraint"), "bad"))
    for column, keys in orphans(wh, table, rows).items():
        counts.append(keys.agg(F.count(F.lit(1)).alias("bad")).select(
            F.lit(f"foreign_key:{column}").alias("constraint"), "bad"))
    values = _broken_values(spec, rows.columns)
    if values:
        counts.append(constraints.count_rows(rows, values).select(
            F.concat_ws(":", "constraint_name", "column_name").alias("constraint"), F.col("bad_rows").alias("bad")))
    return reduce(DataFrame.unionAll, counts).where("bad > 0").collect() if counts else []


def _flagged(wh: Warehouse, table: str, rows: DataFrame, stored: bool) -> DataFrame:
    """The rows with the list of constraints they break."""
    spec = TABLES[table]
    flagged, flags = rows, []
    key = list(_natural_key(spec))
    if key:
        repeated = repeated_keys(wh, table, rows, stored).select(*[F.col(c).alias(f"_k_{c}") for c in key], F.lit(True).alias("_repeated"))
        flagged = flagged.join(repeated, reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key]), "left").drop(*[f"_k_{c}" for c in key])
        flags.append(("_repeated", "primary_key:" + ",".join(key)))
    for column, keys in orphans(wh, table, rows).items():
        lost = keys.select(F.col(column).alias("_k"), F.lit(True).alias(f"_orphan_{column}"))
        flagged = flagged.join(lost, F.col(column) == F.col("_k"), "left").drop("_k")
        flags.append((f"_orphan_{column}", f"foreign_key:{column}"))
    reasons = [F.when(F.col(f), F.lit(name)) for f, name in flags]
    reasons += [F.when(bad, F.lit(f"{name}:{column}")) for name, column, bad in _broken_values(spec, rows.columns)]
    return flagged.select(*rows.columns, F.array_compact(F.array(*reasons)).alias(BROKEN))


def quarantine_path(wh: Warehouse, table: str) -> str:
    return wh.path(f"quarantine.{table}")


def read_quarantined(wh: Warehouse, table: str) -> DataFrame:
    """Rows that were kept out of a mart table, with the constraints they break and the ``check_date`` of the run."""
    return wh.spark.read.parquet(quarantine_path(wh, table))


def enforced(
    wh: Warehouse, table: str, rows: DataFrame, check_date: dt.date, bad_rows: str = "stop", stored: bool = True,
) -> DataFrame:
    """The rows that may be written to the table.

    Broken constraints are logged with the check results. Then ``bad_rows="stop"`` raises QualityError before anything is
    written; ``"quarantine"`` puts the rows into the quarantine folder of the table, all rows of a repeated key
    among them, since nothing tells which one is right. ``stored=False``: the rows replace what is stored.
    """
    found = violations(wh, table, rows, stored)
    if not found:
        return rows
    results = [Row(table_name=table, check_name=r["constraint"], check_date=check_date, check_result=1) for r in found]
    wh.log_checks(results)
    if bad_rows == "stop":
        raise QualityError(f"{table}: constraints broken: " + ", ".join(r["constraint"] for r in found), results)
    flagged = _flagged(wh, table, rows, stored)
    flagged.where(F.size(BROKEN) > 0).write.mode("overwrite").parquet(
        f"{quarantine_path(wh, table)}/check_date={check_date.isoformat()}")
    return flagged.where(F.size(BROKEN) == 0).drop(BROKEN)


def overwrite_enforced(
    wh: Warehouse, table: str, rows: DataFrame, check_date: dt.date, bad_rows: str = "stop", batch_id: int | None = None,
) -> None:
    """``Warehouse.overwrite`` with the rows that ``enforced`` lets through.

    They are computed once: their keys are compared while they are written beside the table (without a shuffle, where they are
    grouped by them), the other constraints are checked on what is stored there. Only where one is broken are they computed
    again, to be logged and set aside.
    """
    flag = "_repeated"
    key = list(_natural_key(TABLES[table]))
    repeated = F.lit(False)
    if key:
        again = F.row_number().over(Window.partitionBy(*key).orderBy(*key)) > 1
        repeated = reduce(Column.__or__, [F.col(k).isNull() for k in key], again)
    kept = wh.overwrite_if(table, rows.withColumn(flag, repeated), flag, lambda there: not violations(
        wh, table, there, stored=False, keyed=False), batch_id)
    if not kept:
        wh.overwrite(table, enforced(wh, table, rows, check_date, bad_rows, stored=False), batch_id)


def replace_enforced(
    wh: Warehouse, table: str, rows: DataFrame, check_date: dt.date, expected: Collection[dt.date], bad_rows: str = "stop",
    batch_id: int | None = None,
) -> None:
    """``Warehouse.replace`` with the rows that ``enforced`` lets through; computed once, as in ``overwrite_enforced``."""
    if not wh.replace_if(table, rows, expected, lambda there: not violations(wh, table, there), batch_id):
        wh.replace(table, enforced(wh, table, rows, check_date, bad_rows), expected, batch_id)
