"""Keys that a stream has not seen yet, by Spark's state store, for a stated horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks the rows that name a new key; the other rows are those of the stream.
NEW_KEY = "_new_key"


def with_new_keys(rows: DataFrame, key: str, horizon: str) -> DataFrame:
    """All rows of the stream, and one more row (only ``key`` set, ``NEW_KEY`` true) per key that is new in its micro-batch.

    The state is one entry per key, not its row, so which of several rows with that key is kept is the
    caller's choice and does not hang on their order in a shuffle. Time is the arrival (the time of the
    micro-batch, which Spark logs, so a repeated batch has the same): no row is ever too late, whatever its
    business date. A key counts as new again ``horizon`` to twice the ``horizon`` after it was first seen; until then
    its copies are found, and the state holds the keys of that time only. NULL is no key.
    """
    arrived = "_arrived"
    keys = rows.where(F.col(key).isNotNull()).select(key, F.current_timestamp().alias(arrived))
    new = keys.withWatermark(arrived, horizon).dropDuplicatesWithinWatermark([key]).select(key)
    return rows.withColumn(NEW_KEY, F.lit(False)).unionByName(
        new.withColumn(NEW_KEY, F.lit(True)), allowMissingColumns=True)
