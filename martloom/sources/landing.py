"""Landing area: where the increments of a business date are put."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources import files

_LISTING_THREADS = 8

DEFAULT_LAYOUT = "{root}/{increment}/{dataset}_inc.csv"


@dataclass(frozen=True)
class Landing:
    """Path rule of the increments; a dataset may be one file or a folder of part files."""

    root: str
    layout: str = DEFAULT_LAYOUT

    def path(self, increment: str, dataset: str) -> str:
        return self.layout.format(root=self.root.rstrip("/"), increment=increment, dataset=dataset)

    @property
    def pattern(self) -> str:
        """The layout as a regular expression with groups ``increment`` and ``dataset``."""
        tail = self.layout.split("{root}", 1)[1]
        parts = re.split(r"(\{increment\}|\{dataset\})", tail)
        groups = {"{increment}": "([^/]+)", "{dataset}": "([^/]+)"}
        return "".join(groups.get(p) or re.escape(p) for p in parts)

    def field(self, path: Column, name: str) -> Column:
        """``increment`` or ``dataset`` as read off a file path."""
        order = sorted(("increment", "dataset"), key=lambda n: self.layout.index("{" + n + "}"))
        return F.regexp_extract(path, self.pattern, order.index(name) + 1)


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Paths and lengths of all files below ``paths``; their content is never read."""

    with ThreadPoolExecutor(_LISTING_THREADS) as pool:
        found = [p for p, there in zip(paths, pool.map(lambda p: files.exists(spark, p), paths)) if there]
    if not found:
        return spark.range(0).select(F.lit("").alias("path"), F.col("id").alias("length"))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(found).select("path", "length")


def files_available(expected: DataFrame, landing: Landing, paths: Sequence[str] = ()) -> DataFrame:
    """Mark each expected (increment, dataset) with check_result 0 (there) or 1 (missing).

    An increment of zero bytes counts as missing. The whole landing area is listed unless the
    ``paths`` to look at are given.
    """
    spark = expected.sparkSession
    landed = (
        list_files(spark, *(paths or [landing.root]))
        .where(F.col("path").rlike(landing.pattern))
        .select(
            landing.field(F.col("path"), "increment").alias("increment"),
            landing.field(F.col("path"), "dataset").alias("dataset"),
            "length",
        )
        .groupBy("increment", "dataset")
        .agg(F.sum("length").alias("_bytes"))
        .where(F.col("_bytes") > 0)
    )
    return expected.join(landed, ["increment", "dataset"], "left").select(
        *expected.columns,
        F.when(F.col("_bytes").isNull(), 1).otherwise(0).alias("check_result"),
    )


def increments_available(
    spark: SparkSession, landing: Landing, increments: Sequence[str], datasets: Sequence[str]
) -> DataFrame:
    """``files_available`` for the increments of a run; only their own paths are listed."""
    paths = [landing.path(i, d) for i in increments for d in datasets]
    return files_available(expected_increments(spark, increments, datasets), landing, paths)


def expected_increments(
    spark: SparkSession, increments: Iterable[str], datasets: Iterable[str]
) -> DataFrame:
    """One row per (increment, dataset) of a run's own plan."""
    one = spark.range(0, 1, 1, 1).select(F.explode(F.lit(list(increments))).alias("increment"))
    return one.select("increment", F.explode(F.lit(list(datasets))).alias("dataset"))
