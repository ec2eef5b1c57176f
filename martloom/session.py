"""Session helpers: shared scratch folder and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where a local session names none (tests) is a temporary folder made, and it is then
    used for checkpoints as well. On a cluster that would be a folder of one machine: an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="martloom-")
        spark.sparkContext.setCheckpointDir(current)
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is written yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system Spark can reach."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_tidying: dict = {}
_lock = threading.Lock()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends inside go at once, not when a garbage collection of the driver finds them.

    For steps whose results are stored. Nested and parallel uses of a session count as one.
    """
    session = spark._jsparkSession  # Python may hold several objects for one session
    with _lock:
        depth, before = _tidying.get(session) or (0, spark.conf.get(_TIDY))
        _tidying[session] = depth + 1, before
        spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        with _lock:
            depth, before = _tidying.pop(session)
            if depth > 1:
                _tidying[session] = depth - 1, before
            else:
                spark.conf.set(_TIDY, before)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, safe against executor loss."""
    shared_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.checkpoint(eager=True)


def literal_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A handful of rows as literals: one partition, no Python worker."""
    rows = list(rows)
    if not rows:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(0, 0, 1, 1).select(*nothing)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
