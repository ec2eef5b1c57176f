"""CSV extracts, read by column name.

Files are scanned as text columns and typed afterwards, because a schema given to
the CSV reader binds by position: with reordered headers it would shift columns
silently. The header line of each increment is read first (no job), the
increments are grouped by header, and each group is one distributed scan.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martloom.operators.cleaning import default_missing_column
from martloom.schemas import TABLES
from martloom.sources import files
from martloom.sources.landing import Landing

# The texts a CSV field may hold for "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

FILE = "_file"
POSITION = "_position"
CORRUPT = "_corrupt_record"
REJECTED = "_rejected"

_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "inferSchema": "false"}
_PROBE_THREADS = 8
_RECORD = ["value", "is_header", "file", "block", "row"]


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a file, or of the first part file of a folder, from its first line: no job is started."""
    found = files.data_files(spark, path)
    line = files.first_line(spark, found[0]) if found else None
    plain = next(csv.reader([line.lstrip("\ufeff")], strict=True)) if line and line.count('"') % 2 == 0 else []
    if not plain or "" in plain or len({c.lower() for c in plain}) < len(plain):
        # Spark has rules of its own for names that are empty, repeated or broken over lines
        return tuple(spark.read.options(**_CSV_OPTIONS).csv(path).columns)
    return tuple(plain)


def _by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    with ThreadPoolExecutor(_PROBE_THREADS) as pool:
        headers = list(pool.map(lambda p: _header(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        groups.setdefault(header, []).append(path)
    return groups


def _surplus_fields(record: Column, width: int) -> Column:
    """True where an unparsed line has more fields than the header (quoted commas aside)."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return commas >= F.lit(width)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in file order as records: an odd number of quotes opens a record of several lines, the next one ends it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        odd = batch["odd"].to_numpy().astype(bool)
        if not held and not odd.any():
            yield batch.select(_RECORD)
            continue
        if held and not odd.any():
            held.append(batch)
            continue
        lines = pa.Table.from_batches([*held, batch]).combine_chunks()
        odd = lines["odd"].to_numpy().astype(np.int64)
        # quotes before a line: where they are even, it starts a record
        starts = np.flatnonzero((np.cumsum(odd) - odd) % 2 == 0)
        end = len(odd) if odd.sum() % 2 == 0 else starts[-1]
        held = lines.slice(end).to_batches()
        starts = starts[starts < end]
        if not len(starts):
            continue
        texts = lines["value"].slice(0, end).combine_chunks().cast(pa.large_string())
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(starts, end), pa.int64()), texts)
        first = lines.select(_RECORD).take(pa.array(starts))
        records = pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string())
        yield from first.set_column(0, "value", records).combine_chunks().to_batches()
    if held:
        yield from pa.Table.from_batches(held).select(_RECORD).to_batches()


def _records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(record, is_header, file, block, row): the records of files whose quoted fields may hold line breaks.

    Files stay splittable. A line break ends a record where the number of quotes before it is even (quotes within a
    field are doubled, so they count twice). A first scan counts the quotes of every byte range; the sums before a range
    tell whether it starts, and whether it ends, inside a record. Records within a range are put together where
    its lines are read. Only the lines of those that lie in several ranges, up to a range's first line with an odd number
    of quotes and from its last one on, are shuffled.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    lines = lines.withColumn("odd", (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd_row = F.when(F.col("odd") == 1, F.col("row"))
    blocks = lines.groupBy("file", "block").agg(
        F.sum("odd").alias("quotes"), F.min("row").alias("first"), F.max("row").alias("last"),
        F.min(odd_row).alias("first_odd"), F.max(odd_row).alias("last_odd"))
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    # a range without such a line lies within a record, or its lines are records
    blocks = blocks.select(
        "file", "block", "first", (before % 2 == 1).alias("inside"),
        F.when(before % 2 == 1, F.coalesce("first_odd", "last")).otherwise(F.lit(-1)).alias("head"),
        F.when((before + F.col("quotes")) % 2 == 1, F.coalesce("last_odd", "first")).alias("tail"))
    # one row per byte range
    placed = lines.join(F.broadcast(blocks), ["file", "block"])
    is_header = (F.col("block") == 0) & (F.col("row") == F.col("first"))
    cut = (F.col("row") <= F.col("head")) | F.coalesce(F.col("row") >= F.col("tail"), F.lit(False))
    placed = placed.select("value", is_header.alias("is_header"), "file", "block", "row", "odd", "inside", "head", cut.alias("cut"))
    text = F.regexp_replace("value", "\\r$", "")
    whole = placed.where("not cut").select(*_RECORD, "odd").mapInArrow(
        _joined, "value string, is_header boolean, file string, block long, row long").select(
        text.alias("record"), *_RECORD[1:])
    # a line inside belongs to the last one before it that starts a record, in an earlier range
    starts = F.when(F.col("row") > F.col("head"), F.struct("block", "row"))
    pieces = placed.where("cut").withColumn("start", F.when(F.col("odd") == 1, starts)).groupBy(
        "file", "block", (F.col("row") > F.col("head")).alias("ending")).agg(
        F.array_sort(F.collect_list(F.struct("row", "value"))).alias("lines"), F.max("is_header").alias("is_header"),
        F.min("start").alias("start"))
    so_far = Window.partitionBy("file").orderBy("block", "ending").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("start", F.last("start", ignorenulls=True).over(so_far))
    joined = pieces.groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("block", "ending", "lines"))).alias("pieces"), F.max("is_header").alias("is_header"))
    value = F.array_join(F.transform(F.flatten(F.col("pieces.lines")), lambda p: p["value"]), "\n")
    long = joined.select(F.regexp_replace(value, "\\r$", "").alias("record"), "is_header", "file",
                         F.col("start.block").alias("block"), F.col("start.row").alias("row"))
    return whole.union(long).where("record <> ''")


def _scan_records(spark: SparkSession, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """As ``_scan``, for files with quoted line breaks."""
    columns = [f"c{i}" for i in range(len(header))]
    ddl = ", ".join([*(f"{c} string" for c in columns), f"{CORRUPT} string"])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = _records(spark, paths).withColumn("fields", F.from_csv("record", ddl, options))
    same = F.array(*[F.col(f"fields.{c}") for c in columns]) == F.array(*map(F.lit, header))
    unlike = F.raise_error(F.concat(F.lit("the header differs from that of the other files: "), "file")).cast("boolean")
    rows = parsed.where(~F.when(F.col("is_header"), F.when(same, True).otherwise(unlike)).otherwise(False))
    corrupt = F.col(f"fields.{CORRUPT}")
    return rows.select(
        *[F.col(f"fields.{c}").alias(name) for c, name in zip(columns, header)],
        F.when(_surplus_fields(corrupt, len(header)), corrupt).alias(CORRUPT), F.col("file").alias(FILE),
        F.struct("file", "block", "row").alias(POSITION))


def _scan(spark: SparkSession, header: tuple[str, ...], paths: list[str], multiline: bool) -> DataFrame:
    if multiline:
        return _scan_records(spark, header, paths)
    fields = [T.StructField(name, T.StringType()) for name in (*header, CORRUPT)]
    # enforceSchema=false makes the reader compare the header of every part file
    # with this one and fail on a difference instead of shifting columns.
    df = (
        spark.read.options(**_CSV_OPTIONS)
        .option("enforceSchema", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")  # a line's surplus fields show only where all are parsed
        .schema(T.StructType(fields))
        .csv(paths)
    )
    return df.select(
        *[F.col(f"`{name}`") for name in header],
        # short lines are padded with NULL; only lines with surplus fields are malformed
        F.when(_surplus_fields(F.col(CORRUPT), len(header)), F.col(CORRUPT)).alias(CORRUPT),
        F.col("_metadata.file_path").alias(FILE),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(POSITION),
    )


def read_csv_by_name(
    spark: SparkSession, paths: str | Sequence[str], multiline: bool = False,
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """Text columns of all paths, matched by name; absent columns are NULL.

    ``defaults`` gives the value of a column for the rows of those files that lack it; a
    NULL in a file that has it stays.

    Adds ``_file``, ``_position`` (file order of a row) and ``_corrupt_record`` (the
    line, where it has more fields than its header). Quoted line breaks need
    ``multiline=True``: files are split all the same, and read twice.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    scans = [_scan(spark, h, p, multiline) for h, p in _by_header(spark, paths).items()]
    for column, value in (defaults or {}).items():
        scans = [default_missing_column(s, column, value) for s in scans]
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan, allowMissingColumns=True)
    return out


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Replace the "no value" texts by NULL in the given (default: all) text columns."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    wanted = text if columns is None else text & set(columns)
    wanted -= {FILE, CORRUPT}
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)) for c in df.columns if c in wanted}
    )


_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_COMPACT_DATE = r"^\s*(\d{4})(\d{2})(\d{2})(\.0+)?\s*$"


def _typed(c: Column, target: T.DataType) -> Column:
    """Converted value, NULL where the text is none of the type.

    A cast that fails raises and catches an error per row, which is slow where it happens
    often, and a regular expression per cell is slow too. So cheap looks at the text pick the
    cast that will do, and expressions are left for the rare forms.
    """
    # digits, signs, points and blanks all sort before the colon, letters after it
    numeric = c < F.lit(":")
    if isinstance(target, T.IntegralType):
        # "5.0" is how an integer column with gaps is written; halves round away from zero
        rounded = F.round(c.try_cast("decimal(38,18)"), 0).try_cast(target)
        other = F.when(c.rlike(_NUMBER), rounded)
        return F.when(numeric, F.when(c.contains("."), rounded).otherwise(F.coalesce(c.try_cast(target), other)))
    if isinstance(target, T.DecimalType):
        return F.when(numeric, c.try_cast(target))
    if isinstance(target, (T.TimestampNTZType, T.DateType)):
        compact = F.regexp_replace(c, _COMPACT_DATE, "$1-$2-$3").try_cast(target)
        return F.when(c.contains("-"), c.try_cast(target)).when(c.rlike(_COMPACT_DATE), compact)
    return c.try_cast(target)


def infer_and_cast(df: DataFrame, schema: T.StructType, on_error: str = "raise") -> DataFrame:
    """Type text columns by name.

    ``on_error="raise"`` stops the job on a value that cannot be converted, as loading
    it into a typed table would. ``"flag"`` keeps the row and lists the failing columns
    in ``_rejected`` (see ``split_rejects``).
    """
    if on_error not in ("raise", "flag"):
        raise ValueError(f"on_error must be 'raise' or 'flag', not {on_error!r}")
    present = [f for f in schema if f.name in df.columns]
    names = {f.name for f in present}
    others = [F.col(c) for c in df.columns if c not in names and c != CORRUPT]
    # converted once, in a projection of its own, and then compared with the text
    df = df.withColumns({f"_typed_{f.name}": _typed(F.col(f.name), f.dataType) for f in present})
    typed, failures = [], []
    for f in present:
        text, value = F.col(f.name), F.col(f"_typed_{f.name}")
        if isinstance(f.dataType, T.StringType):
            typed.append(value.alias(f.name))
            continue
        failed = text.isNotNull() & value.isNull()
        if on_error == "raise":
            message = F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), text)
            value = F.when(failed, F.raise_error(message).cast(f.dataType)).otherwise(value)
        failures.append(F.when(failed, F.lit(f.name)))
        typed.append(value.alias(f.name))
    if CORRUPT in df.columns:
        corrupt = F.col(CORRUPT)
        if on_error == "raise":
            message = F.concat(F.lit("more fields than the header: "), corrupt)
            others.append(
                F.when(corrupt.isNotNull(), F.raise_error(message).cast("string")).alias(CORRUPT)
            )
        else:
            others.append(corrupt)
            failures.append(F.when(corrupt.isNotNull(), F.lit(CORRUPT)))
    if on_error == "flag":
        others.append(F.array_compact(F.array(*failures)).alias(REJECTED))
    return df.select(*typed, *others)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the flag, rejected rows with it)."""
    clean = F.size(REJECTED) == 0
    return df.where(clean).drop(REJECTED, CORRUPT), df.where(~clean)


_ROUTE = "_route"


def route_rejects(df: DataFrame, path: str) -> None:
    """Write flagged rows (``on_error="flag"``) once: accepted and rejected ones side by side, from one scan."""
    side = F.when(F.size(REJECTED) == 0, "accepted").otherwise("rejected")
    df.withColumn(_ROUTE, side).write.partitionBy(_ROUTE).parquet(path)


def read_routed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the flag, rejected rows with it) of what ``route_rejects`` has written.

    A rejected value is NULL, its column is named in the flag, and only the rows' own folder is read.
    """
    both = spark.read.parquet(path)
    rows = lambda side: both.where(F.col(_ROUTE) == side).drop(_ROUTE)
    return rows("accepted").drop(REJECTED, CORRUPT), rows("rejected")


def read_full_csv(
    spark: SparkSession, path: str, dataset: str, on_error: str = "raise", multiline: bool = False
) -> DataFrame:
    """Whole-history extract of a dataset: listed columns only, typed, "no value" as NULL.

    ``multiline=True`` reads quoted line breaks, at the price of a second scan.
    """
    spec = TABLES[f"staging.{dataset}"]
    columns = [c for c in spec.data_columns if c not in spec.optional]
    raw = read_csv_by_name(spark, path, multiline)
    raw = raw.select(*columns, FILE, POSITION, CORRUPT)
    typed = infer_and_cast(nan_to_null(raw), spec.schema, on_error)
    if on_error == "flag":
        return typed.select(*columns, REJECTED, CORRUPT)
    return typed.select(*_checked(columns, spec.optional))


def _checked(columns: Sequence[str], optional: Sequence[str]) -> list[Column]:
    """The columns, the required ones with the check for surplus fields, so that pruning does not lose it.

    An optional column may be a constant, which Spark cannot read beside the check alone.
    """
    return [F.col(c) if c in optional else F.when(F.col(CORRUPT).isNull(), F.col(c)).alias(c) for c in columns]


def read_increment_csv(
    spark: SparkSession,
    landing: Landing,
    dataset: str,
    increments: Sequence[str],
    on_error: str = "raise",
    defaults: Mapping[str, str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Extracts of the given increments, typed; every known column found in a file is kept.

    The result carries ``increment``, ``_file`` and ``_position``. Optional columns a file
    does not have stay absent if no file has them, else they are NULL for its rows, or the
    value given for them in ``defaults``.
    """
    spec = TABLES[f"staging.{dataset}"]
    raw = read_csv_by_name(spark, [landing.path(i, dataset) for i in increments], multiline, defaults)
    known = [c for c in spec.data_columns if c in raw.columns]
    missing = [c for c in spec.data_columns if c not in known and c not in spec.optional]
    if missing:
        raise ValueError(f"{dataset}: columns {missing} are in none of the files")
    raw = raw.select(*known, landing.field(F.col(FILE), "increment").alias("increment"), FILE, POSITION, CORRUPT)
    typed = infer_and_cast(nan_to_null(raw, known), spec.schema, on_error)
    extra = ["increment", FILE, POSITION]
    if on_error == "flag":
        return typed.select(*known, *extra, REJECTED, CORRUPT)
    return typed.select(*_checked(known, spec.optional), *extra)
