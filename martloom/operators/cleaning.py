"""Row cleaning of one increment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import SHIPPED, null_spread

if TYPE_CHECKING:
    from martloom.sources.key_index import KeyIndex


def project_named_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in that order; a missing one is an AnalysisException."""
    return df.select(*columns)


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def default_missing_column(df: DataFrame, column: str = "status", value: str = SHIPPED) -> DataFrame:
    """Fill a column the source does not have yet; NULLs in an existing one stay."""
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per key in the given order; NULL keys are equal to each other.

    ``order_by`` should be a total order within a key. An aggregate, not a window: every
    map task reduces a hot (or NULL) key to one row before the shuffle, and the sort-based
    aggregate spills.
    """
    # the struct is never NULL, so rows whose order columns are all NULL are not lost
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order_by))
    return df.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(
        first.alias("_row")
    ).select("_row.*")


def dedup_if_keyed(df: DataFrame, key: str, order_by: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """``dedup_keep_first`` where the source has the key column, else all rows."""
    return dedup_keep_first(df, [*within, key], order_by) if key in df.columns else df


def dedup_against_history(df: DataFrame, history: DataFrame, key: str = "uniq_id") -> DataFrame:
    """Rows whose key is not staged yet; rows without a key are kept."""
    # pmod(x, 1) is 0 for every key; written so that it stays a join key
    seen = history.select(
        F.col(key).alias("_seen"), F.pmod(F.xxhash64(key), F.lit(1)).alias("_seen_spread")
    )
    rows = df.withColumn("_spread", null_spread(key, *df.columns))
    unseen = rows.join(
        seen, (F.col(key) == F.col("_seen")) & (F.col("_spread") == F.col("_seen_spread")), "left_anti"
    )
    return unseen.select(*df.columns)


def dedup_against_index(df: DataFrame, index: KeyIndex, key: str = "uniq_id", since: dt.date | str | None = None) -> DataFrame:
    """``dedup_against_history`` where the staged keys are stored in buckets: history is not shuffled.

    ``since`` looks at the loads from that date on only, whatever is stored before. Rows without a key are kept
    and take no part in the join, so they are no hot key.
    """
    keyed = index.unknown(df.where(F.col(key).isNotNull()), [key], since)
    return keyed.select(*df.columns).union(df.where(F.col(key).isNull()))
