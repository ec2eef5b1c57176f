"""The load manifest: which business dates each load of a staging table holds, and how many rows of each.

It is written with the staging loads and answers which loads a business date is spread over, so that marts read
those partitions only, without a look at the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.sources.warehouse import Warehouse

TABLE = "staging.load_manifest"
# The column that holds the business date of each dataset.
BUSINESS_DATE: Mapping[str, str] = {
    "customer_research": "date_id", "user_order_log": "date_time", "user_activity_log": "date_time", "price_log": "datetime",
}


def _counted(wh: Warehouse, dataset: str, days: Sequence[dt.date] | None) -> DataFrame:
    rows = wh.read(f"staging.{dataset}")
    if days is not None:
        rows = rows.where(F.col("load_date").isin(*days))
    stamp = F.col(BUSINESS_DATE[dataset]).cast("date").alias("business_date")
    return rows.groupBy(stamp, "load_date").agg(F.count(F.lit(1)).alias("row_count")).withColumn("dataset", F.lit(dataset))


def record(wh: Warehouse, days: Sequence[dt.date], batch_id: int | None = None) -> None:
    """Entries of the loads ``days``, from one column of what they have just staged."""
    counted = reduce(DataFrame.unionByName, [_counted(wh, name, days) for name in BUSINESS_DATE])
    wh.replace(TABLE, counted, days, batch_id)


def rebuild(wh: Warehouse) -> None:
    """All entries again, for a warehouse whose staging tables are older than its manifest or were reloaded."""
    wh.overwrite(TABLE, reduce(DataFrame.unionByName, [_counted(wh, name, None) for name in BUSINESS_DATE]))


def business_dates(wh: Warehouse, dataset: str, days: Sequence[dt.date]) -> set[dt.date]:
    """Dates of the rows that the loads hold: at most one per calendar day."""
    found = wh.read(TABLE).where(F.col("load_date").isin(*days) & (F.col("dataset") == dataset))
    dates = found.select("business_date").distinct().collect()
    return {r["business_date"] for r in dates if r["business_date"] is not None}


def loads_of(wh: Warehouse, dataset: str, dates: Collection[dt.date]) -> DataFrame:
    """(load_date) of the loads that hold rows of these business dates."""
    wanted = (F.col("dataset") == dataset) & F.col("business_date").isin(*dates)
    return wh.read(TABLE).where(wanted).select("load_date").distinct()


def staged(wh: Warehouse, dataset: str, dates: Collection[dt.date], table: str | None = None) -> DataFrame:
    """The rows of a staging table (or of ``table``, partitioned like it) in the loads that hold these business dates.

    Spark prunes the partitions by the joined load dates before it opens a file. The joined side has one row
    per load, so at most one per calendar day, and is broadcast.
    """
    loads = F.broadcast(loads_of(wh, dataset, dates))
    return wh.read(table or f"staging.{dataset}").join(loads, "load_date", "left_semi")
