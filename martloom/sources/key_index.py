"""Keys of a table, stored in buckets by their hash, so that new keys meet them without moving them."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.sources import files

LEAST_BUCKETS = 16


class KeyIndex:
    """The key columns of a table as a bucketed Parquet table at ``path``.

    A join on the key shuffles the other side to the buckets (or broadcasts it) and leaves the index where it is.
    The number of buckets is fixed when the index is first written: at least the number of shuffle partitions,
    since Spark deals fewer buckets anew. ``partition`` names a date column of loads: a repeated load replaces
    its keys, and a window of dates reads only its own folders.

    The index is derived data. ``sync`` builds it again where its number of rows is not the table's, after a
    load that ended between the two writes.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[T.StructField], partition: str | None = None):
        self.spark, self.key, self.partition = spark, list(key), partition
        self.columns = [f.name for f in key]
        found = [int(n.removeprefix("buckets=")) for n in files.names(spark, path) if n.startswith("buckets=")]
        self.buckets = found[0] if found else max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.path = f"{path.rstrip('/')}/buckets={self.buckets}"
        self.name = f"key_index_{hashlib.sha256(self.path.encode()).hexdigest()[:20]}"
        if not spark.catalog.tableExists(self.name):
            declared = [f"`{f.name}` {f.dataType.simpleString()}" for f in key]
            if partition:
                declared.append(f"`{partition}` date")
            spark.sql(
                f"create table {self.name} ({', '.join(declared)}) using parquet "
                + (f"partitioned by (`{partition}`) " if partition else "")
                + f"clustered by ({', '.join(f'`{c}`' for c in self.columns)}) into {self.buckets} buckets "
                + f"location '{self.path}'")
            if partition and found:
                spark.sql(f"msck repair table {self.name}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _insert(self, keys: DataFrame, how: str, partition: str = "") -> None:
        # one file per bucket: the shuffle and the buckets have the same hash
        dealt = keys.select(*[F.col(f.name).cast(f.dataType) for f in self.key]).repartition(self.buckets, *self.columns)
        view = f"keys_{uuid.uuid4().hex}"
        dealt.createOrReplaceTempView(view)
        try:
            self.spark.sql(f"insert {how} table {self.name} {partition} select * from {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def add(self, keys: DataFrame) -> None:
        """Keys of rows that were added to the table."""
        self._insert(keys, "into")

    def replace(self, keys: DataFrame, load: str | None = None) -> None:
        """All keys, or those of one load."""
        self._insert(keys, "overwrite", f"partition (`{self.partition}` = date'{load}')" if load else "")

    def sync(self, table: DataFrame) -> bool:
        """Build the index again if it does not have the table's number of rows; both are counted from file footers."""
        if self.read().count() == table.count():
            return False
        self.replace(table.select(*self.columns))
        return True

    def _on(self, rows: DataFrame, columns: Sequence[str] | None):
        return [F.col(mine) == F.col(f"_key_{i}") for i, mine in enumerate(columns or self.columns)]

    def _keys(self, since=None) -> DataFrame:
        stored = self.read()
        if since is not None:
            stored = stored.where(F.col(self.partition) >= F.lit(since).cast("date"))
        return stored.select(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(self.columns)])

    def known(self, rows: DataFrame, columns: Sequence[str] | None = None, since=None) -> DataFrame:
        """Rows whose key is stored (in a load of ``since`` or later); ``columns`` are their names for the key."""
        return rows.join(self._keys(since), self._on(rows, columns), "left_semi")

    def unknown(self, rows: DataFrame, columns: Sequence[str] | None = None, since=None) -> DataFrame:
        """Rows whose key is not stored; a key with a NULL counts as such."""
        return rows.join(self._keys(since), self._on(rows, columns), "left_anti")
