"""New-key detection and surrogate ids for the dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.session import materialise


def new_keys_not_in(rows: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """``WHERE key NOT IN (SELECT dim_key FROM dim)`` with SQL's three-valued logic.

    A NULL in the dimension lets nothing through; a NULL key passes only when the dimension
    is empty. Spark plans ``NOT IN`` as a broadcast of the dimension whatever its size; here
    the NULL cases are two scalar subqueries and the rest is a plain anti join, for which
    Spark picks a broadcast or a sort-merge join from the size.

    Where many rows share a key, reduce them to distinct candidates first, as the dimension
    operators do.
    """
    known = dim.select(F.col(dim_key or key).alias("_known"))
    dim_rows = known.select(F.count(F.lit(1))).scalar()
    dim_nulls = known.select(F.count_if(F.col("_known").isNull())).scalar()
    passes = (dim_rows == 0) | ((dim_nulls == 0) & F.col(key).isNotNull())
    return rows.where(passes).join(known, F.col(key) == F.col("_known"), "left_anti")


def surrogate_ids(
    df: DataFrame, order_by: Sequence[str], id_column: str = "id", existing: DataFrame | None = None
) -> DataFrame:
    """Dense ids in the given order, going on after the largest id of ``existing``.

    Equals ``row_number() over (order by …)`` plus that maximum, without a one-task window:
    the rows are range-partitioned on the order columns (a sample sets the bounds, and rows
    that share a first column but differ later can be split), numbered within each
    partition, written once as a checkpoint, and shifted by the sizes of the partitions
    before theirs. Order columns that are not unique leave the order of ties open.
    """
    local = F.monotonically_increasing_id()
    numbered = materialise(
        df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order_by])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order_by])
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", local.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    # one row per partition: bounded by the partition count, not by the data
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    base = F.lit(0) if existing is None else F.coalesce(
        existing.select(F.max(id_column)).scalar(), F.lit(0)
    )
    new_id = (base + F.col("_offset") + F.col("_row") + 1).cast("bigint")
    return numbered.join(F.broadcast(offsets), "_part").select(
        new_id.alias(id_column), *[c for c in df.columns if c != id_column]
    )
