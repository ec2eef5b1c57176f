"""Orders as a stream: landed files feed the staging table and the marts, repeated keys are dropped by keyed state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martloom.operators.cleaning import dedup_keep_first, default_missing_column
from martloom.operators.quality import block_rows
from martloom.plans import runs
from martloom.schemas import TABLES, conform
from martloom.session import delete, scratch_path
from martloom.sources import files
from martloom.sources.csv_files import FILE, infer_and_cast, nan_to_null
from martloom.sources.landing import Landing
from martloom.sources.warehouse import Warehouse, last_tag, replace_partitions
from martloom.streaming.ingest import BLOCK, file_stream
from martloom.streaming.keyed import NEW_KEY, with_new_keys

DATASET, KEY = "user_order_log", "uniq_id"
TABLE = f"staging.{DATASET}"
#: Columns of the order files, in the declared order.
COLUMNS = tuple(c for c in TABLES[TABLE].columns if c not in ("id", "load_date"))
_ROW = "_row"


def _first_of_new(batch: DataFrame) -> DataFrame:
    """Of each key that is new, its first row in path and file order; rows without a key once per file."""
    order = [FILE, BLOCK, _ROW]
    rows = batch.where(~F.col(NEW_KEY)).drop(NEW_KEY)
    new = batch.where(NEW_KEY).select(KEY)
    keyed = dedup_keep_first(rows.where(F.col(KEY).isNotNull()), [KEY], order).join(new, KEY, "left_semi")
    return keyed.unionByName(dedup_keep_first(rows.where(F.col(KEY).isNull()), [FILE], order))


def _stage(wh: Warehouse, rows: DataFrame, days: Sequence, bad_rows: str, tag: str) -> None:
    """Add the rows to their loads, once per tag: a repeated micro-batch finds its tag and adds nothing.

    An increment may come in several micro-batches, so what a load holds already is written again with the new rows.
    """
    if bad_rows == "quarantine":
        rows, blocked = block_rows(rows, runs.RULES[DATASET])
        path = runs.quarantine_path(wh, DATASET)
        if last_tag(wh.spark, path) != tag:
            if files.exists(wh.spark, path):
                blocked = blocked.unionByName(runs.read_quarantine(wh, DATASET).where(F.col("load_date").isin(*days)))
            replace_partitions(blocked, path, "load_date", days, tag=tag)
    if last_tag(wh.spark, wh.path(TABLE)) != tag:
        there = wh.read(TABLE).where(F.col("load_date").isin(*days))
        wh.replace(TABLE, rows.unionByName(there), days, tag=tag)


def stream_to_marts(
    spark: SparkSession, landing: Landing, root: str, checkpoint: str, horizon: str = "30 days",
    columns: Sequence[str] = COLUMNS, fmt: str = "csv", files_per_batch: int = 1000, bad_rows: str = "stop",
) -> StreamingQuery:
    """Load the order files that have landed and are not loaded yet into staging and the marts, then stop.

    An order (``uniq_id``) that comes again in any later file within ``horizon`` is dropped; of several in one
    micro-batch the first in path and file order is kept (``streaming.keyed``). Rows are staged under the increment their
    path names, then checks, new dimension rows, signed daily sales, sales and retention follow as in ``run_backfill``
    for the dates of the new rows; late orders repair the dates they belong to. A micro-batch costs what it
    brings and the loads and dates it touches, whatever was loaded before them.

    Whatever step a run ends at, the next one with the same ``checkpoint`` completes it: staging knows the last
    micro-batch it holds, all later steps replace what they write. Without its checkpoint a stream starts
    anew and stages everything again, so empty its loads first. ``columns``: header of the files (one for all).
    A broken check stops the stream with the rows staged; ``bad_rows="quarantine"`` sets them aside.
    """
    runs.known_choice(bad_rows)
    wh = runs.open_warehouse(spark, root)
    declared = TABLES[TABLE].schema
    schema = T.StructType([declared[c] for c in columns])
    source = file_stream(spark, landing.path("*", DATASET), schema, fmt, files_per_batch)
    if fmt == "csv":
        source = infer_and_cast(nan_to_null(source, schema.fieldNames()), schema)

    def load(batch: DataFrame, batch_id: int) -> None:
        # written once: a second evaluation would run the state operator again
        path = scratch_path(spark, "micro-batch")
        batch.withColumn(_ROW, F.monotonically_increasing_id()).write.parquet(path)
        try:
            stored = batch.sparkSession.read.schema(T.StructType([*batch.schema, T.StructField(_ROW, T.LongType())])).parquet(path)
            rows = default_missing_column(_first_of_new(stored))
            rows = conform(rows.withColumn("load_date", landing.field(F.col(FILE), "increment").cast("date")), TABLE)
            seen = rows.select("load_date", F.col("date_time").cast("date").alias("sale_date")).distinct().collect()
            if not seen:
                return
            days = sorted({r["load_date"] for r in seen})
            _stage(wh, rows, days, bad_rows, f"{checkpoint}#{batch_id}")
        finally:
            delete(spark, path)
        runs.settle(wh, days, days[-1], False, bad_rows, None, [DATASET])
        touched = {r["sale_date"] for r in seen if r["sale_date"] is not None}
        if touched:
            runs.refresh_marts(wh, touched, days[-1], bad_rows=bad_rows)

    return (
        with_new_keys(source, KEY, horizon).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
