"""Tables of the staging and mart layers as Parquet folders, and the ways to load them."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.schemas import TABLES, TableSpec, conform
from martloom.session import literal_frame, materialise, tidy
from martloom.sources import files
from martloom.sources.key_index import KeyIndex

_SWAP_THREADS = 8


def overwrite_table(df: DataFrame, path: str, reads_target: bool = False) -> None:
    """Replace the whole table.

    ``reads_target=True`` computes the new content first, for a plan that reads ``path``.
    """
    if reads_target:
        df = materialise(df)
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Add rows; the table is made if absent. A rerun adds them again."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def _balanced(df: DataFrame, partition: str, serial: str | None, spread: bool = True) -> DataFrame:
    """Rows spread for a write by ``partition``, then numbered.

    ``spread=False`` leaves the rows in the tasks that made them, for loads of one partition value.

    Numbering comes after the last shuffle: a task that is repeated then numbers and writes
    its own file again, and no other task has seen its numbers.
    """
    out = df.hint("rebalance", partition) if spread else df
    return out.withColumn(serial, row_ids(F.col(partition))) if serial else out


_COMMIT, _TAG = "_commit", "_tag"


def replace_partitions(
    df: DataFrame, path: str, partition: str, expected: Iterable[dt.date] = (), serial: str | None = None,
    tag: str | None = None, spread: bool = True, accepted: Callable[[str], bool] | None = None,
) -> bool:
    """Write date partitions so that a rerun replaces them, all of them or none.

    The rows go to a hidden folder first, in one job whatever the number of dates. Then a small commit record
    names that folder and the dates to replace or empty, and the partitions change places. A run that ends before the
    record leaves the table as it was; one that ends after it is completed by the next one to read or write
    (``finish_replace``). One writer per table at a time.

    Rows are rebalanced on the partition column, where Spark splits partitions that are
    too large, so one hot date is written by many tasks. A date in ``expected`` that has no
    rows in this run is emptied. ``serial`` names a column to fill with row numbers. ``tag`` names the load
    (see ``last_tag``). ``accepted`` looks at the hidden folder before anything is replaced; the result says whether it was.
    """
    spark = df.sparkSession
    finish_replace(spark, path)
    folder = f"_next-{uuid.uuid4().hex}"
    _balanced(df, partition, serial, spread).write.partitionBy(partition).parquet(f"{path}/{folder}")
    if accepted is not None and not accepted(f"{path}/{folder}"):
        files.delete(spark, f"{path}/{folder}")
        return False
    filled = [n for n in files.names(spark, f"{path}/{folder}") if n.startswith(f"{partition}=")]
    emptied = sorted({f"{partition}={d.isoformat()}" for d in expected} - set(filled))
    record = {"folder": folder, "filled": filled, "emptied": emptied, "tag": tag}
    files.write_text(spark, f"{path}/{_COMMIT}", json.dumps(record))
    finish_replace(spark, path)
    return True


def finish_replace(spark: SparkSession, path: str) -> None:
    """Carry out what a commit record says, if there is one; repeated steps do no harm."""
    text = files.read_text(spark, f"{path}/{_COMMIT}")
    if text is None:
        return
    record = json.loads(text)
    waiting = set(record["filled"]) & set(files.names(spark, f"{path}/{record['folder']}"))
    with ThreadPoolExecutor(_SWAP_THREADS) as pool:
        def swap(name: str) -> None:
            files.delete(spark, f"{path}/{name}")
            if name in waiting:
                files.move(spark, f"{path}/{record['folder']}/{name}", f"{path}/{name}")

        list(pool.map(swap, [*record["emptied"], *sorted(waiting)]))
    if record["tag"] is not None:
        files.write_text(spark, f"{path}/{_TAG}", record["tag"])
    files.delete(spark, f"{path}/{record['folder']}")
    files.delete(spark, f"{path}/{_COMMIT}")


def last_tag(spark: SparkSession, path: str) -> str | None:
    """The tag of the last tagged load that was committed."""
    finish_replace(spark, path)
    return files.read_text(spark, f"{path}/{_TAG}")


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """Schema migration: existing rows get NULL in the new column."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def merge_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows together, matched by name; columns one side lacks are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


_DAY_BITS, _PARTITION_BITS, _ROW_BITS = 16, 22, 25


def row_ids(load_date: Column) -> Column:
    """Unique row numbers for staging loads, without a shuffle or a read of the table.

    Ids grow but are not dense. The day number of the load is the high part, so loads of
    different dates never meet: 16 bits of day (1970 to 2149), 22 of partition, 25 of row.
    """
    raw = F.monotonically_increasing_id()
    return packed_id(F.unix_date(load_date).cast("bigint"), F.shiftright(raw, 33), raw.bitwiseAND(F.lit((1 << 33) - 1)))


def packed_id(day: Column, partition: Column, row: Column) -> Column:
    """One positive number from a day, a partition of its load and a row of the partition.

    Four million partitions are some 256 TB at 64 MB each. What does not fit stops the load.
    """
    def fits(c: Column, bits: int, what: str) -> Column:
        return F.when((c >= 0) & (c < (1 << bits)), c).when(
            c.isNotNull(), F.raise_error(F.concat(F.lit(f"{what} out of the id range: "), c.cast("string"))).cast("bigint"))

    return (F.shiftleft(fits(day, _DAY_BITS, "load date"), _PARTITION_BITS + _ROW_BITS)
            + F.shiftleft(fits(partition, _PARTITION_BITS, "partition"), _ROW_BITS) + fits(row, _ROW_BITS, "row"))


class Warehouse:
    """Declared tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def exists(self, table: str) -> bool:
        return files.exists(self.spark, self.path(table))

    def create_tables(self, tables: Iterable[str] = tuple(TABLES), if_absent: bool = False) -> None:
        """Create the tables empty; existing ones are emptied unless ``if_absent``."""
        def create(name: str) -> None:
            if if_absent and self.exists(name):
                return
            spec = TABLES[name]
            empty = literal_frame(self.spark, [], spec.schema)
            empty.write.mode("overwrite").partitionBy(*spec.partition_by).parquet(self.path(name))

        with ThreadPoolExecutor(_SWAP_THREADS) as pool:
            list(pool.map(create, tables))

    def read(self, table: str) -> DataFrame:
        """Scan with the declared schema; only the columns used later are read."""
        spec = TABLES[table]
        if spec.partition_by:
            finish_replace(self.spark, self.path(table))
        return self.spark.read.schema(spec.schema).parquet(self.path(table))

    def keys(self, table: str) -> KeyIndex:
        """The index of the table's primary key."""
        spec = TABLES[table]
        return KeyIndex(self.spark, f"{self.root}/index/{table}", [f for f in spec.schema if f.name in spec.primary_key])

    def indexed_keys(self, table: str) -> KeyIndex:
        """The index, first built again if a load ended before its keys were added."""
        index = self.keys(table)
        index.sync(self.read(table))
        return index

    def overwrite(self, table: str, df: DataFrame, batch_id: int | None = None, spread: bool = True) -> None:
        """Replace the table. ``spread=False``: all rows have one partition value, so no shuffle is needed."""
        spec = TABLES[table]
        with _Audit(self, table, batch_id) as audit:
            out = audit.counted(conform(df, spec))
            if spec.partition_by:
                self._replace_all(spec, out, spread)
            else:
                out.write.mode("overwrite").parquet(self.path(table))

    def overwrite_if(
        self, table: str, df: DataFrame, bad: str, accepted: Callable[[DataFrame], bool], batch_id: int | None = None,
    ) -> bool:
        """``overwrite`` with rows that are computed once: whether they have replaced the table.

        They are written beside it, in its types, and take its place if every value fits its type, the boolean column ``bad``
        is nowhere true and ``accepted`` says so of the stored rows. Else nothing has changed. For tables without partitions.
        """
        spec, beside = TABLES[table], f"{self.path(table)}._next-{uuid.uuid4().hex}"
        with _Audit(self, table, batch_id) as audit:
            typed, found = _unstopped(audit.counted(df), spec, F.col(bad))
            typed.write.parquet(beside)
            good = _count(found) == 0 and accepted(self.spark.read.schema(spec.schema).parquet(beside))
            if good:
                files.delete(self.spark, self.path(table))
                files.move(self.spark, beside, self.path(table))
            else:
                files.delete(self.spark, beside)
                audit.batch_id = None  # nothing was loaded
        return good

    def replace_if(
        self, table: str, df: DataFrame, expected: Iterable[dt.date], accepted: Callable[[DataFrame], bool],
        batch_id: int | None = None,
    ) -> bool:
        """``replace`` with rows that are computed once: whether they have replaced their partitions.

        They do if every value fits its type and ``accepted`` says so of the rows as written. Else nothing has changed.
        """
        spec = TABLES[table]
        with _Audit(self, table, batch_id) as audit:
            typed, found = _unstopped(audit.counted(df), spec)
            good = replace_partitions(
                typed, self.path(table), spec.partition_by[0], expected, spec.serial, accepted=lambda folder:
                _count(found) == 0 and accepted(self.spark.read.schema(spec.schema).parquet(folder)))
            if not good:
                audit.batch_id = None  # nothing was loaded
        return good

    def _replace_all(self, spec: TableSpec, out: DataFrame, spread: bool) -> None:
        (partition,), path = spec.partition_by, self.path(spec.name)
        finish_replace(self.spark, path)
        there = [n.removeprefix(f"{partition}=") for n in files.names(self.spark, path) if n.startswith(f"{partition}=")]
        dates = [dt.date.fromisoformat(d) for d in there if not d.startswith("__")]
        replace_partitions(out, path, partition, dates, spec.serial, spread=spread)

    def append(self, table: str, df: DataFrame, batch_id: int | None = None) -> None:
        with _Audit(self, table, batch_id) as audit:
            append_table(audit.counted(conform(df, table)), self.path(table), TABLES[table].partition_by)

    def replace(
        self, table: str, df: DataFrame, expected: Iterable[dt.date] = (), batch_id: int | None = None,
        tag: str | None = None,
    ) -> None:
        """Replace the date partitions ``df`` holds and empty the other expected ones."""
        spec: TableSpec = TABLES[table]
        with _Audit(self, table, batch_id) as audit:
            replace_partitions(audit.counted(conform(df, spec)), self.path(table), spec.partition_by[0], expected,
                               spec.serial, tag)

    def log_checks(self, results: Iterable) -> None:
        """Append quality results, one row per check."""
        spec = TABLES["dq_checks_results"]
        rows = [tuple(r[c] for c in spec.columns) for r in results]
        append_table(literal_frame(self.spark, rows, spec.schema), self.path(spec.name))


def _unstopped(df: DataFrame, spec: TableSpec, bad: Column | None = None) -> tuple[DataFrame, Observation]:
    """``conform``, but a value that does not fit becomes NULL, and the rows with one (or with ``bad``) are counted.

    For rows whose constraints are checked once they are written: a cast that stops the job would leave them unchecked.
    """
    source = {f.name: f.dataType for f in df.schema}
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in spec.schema if source.get(f.name, f.dataType) != f.dataType}
    lost = [F.col(c).isNotNull() & cast.isNull() for c, cast in casts.items()]
    lost = reduce(Column.__or__, lost, F.lit(False) if bad is None else bad)
    found = Observation(f"bad rows for {spec.name}")
    own = [casts.get(c, F.col(c)).alias(c) for c in df.columns if c in {f.name for f in spec.schema}]
    return conform(df.select(*own, lost.alias("_lost")).observe(found, F.count_if("_lost").alias("rows")), spec), found


def _count(observed: Observation) -> int:
    """What a write that has just ended has counted."""
    try:
        return observed.get["rows"]
    except Py4JJavaError:
        # the write succeeded, so its plan was one that Spark had found to be empty and keeps no metrics of
        return 0


class _Audit:
    """Writes one mart.load_history row per finished load of a batch, with the number of rows it wrote.

    A repeated load of a batch replaces its row. Shuffles of a load end with it (``tidy``).
    """

    def __init__(self, warehouse: Warehouse, table: str, batch_id: int | None):
        self.warehouse, self.table, self.batch_id = warehouse, table, batch_id
        self.observed = None
        self.tidy = tidy(warehouse.spark)

    @staticmethod
    def _now() -> dt.datetime:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def counted(self, rows: DataFrame) -> DataFrame:
        """The rows, counted while they are written."""
        if self.batch_id is None:
            return rows
        self.observed = Observation(f"rows of {self.table}")
        return rows.observe(self.observed, F.count(F.lit(1)).alias("rows"))

    def __enter__(self):
        self.start = self._now()
        self.tidy.__enter__()
        return self

    def __exit__(self, failure, *_):
        self.tidy.__exit__(None, None, None)
        if failure is None and self.batch_id is not None:
            spec = TABLES["mart.load_history"]
            row = [(self.start, self._now(), _count(self.observed), self.batch_id, self.table)]
            history = literal_frame(self.warehouse.spark, row, spec.schema).drop("batch_id", "target_table")
            folder = f"{self.warehouse.path(spec.name)}/batch_id={self.batch_id}/target_table={self.table}"
            # of a batch and table there is one row
            history.write.mode("overwrite").parquet(folder)
        return False
