"""License scan in DataFrame operations only: TF-IDF cosine to templates, then inheritance along directories.

A file's units are each of its lines (headers, notices) and its whole text (licence files). Words are runs of ASCII
letters and digits, lower-cased; weights are ``tf * idf`` with idf = ln((N + 1) / (df + 1)) + 1 over all files, where
words outside all templates count as never seen. A unit carries the template of the largest cosine, if that is
``THRESHOLD`` or more (equal ones: the first name); a file the best of its lines' (equal ones: the first line).

Only files that contain a marker word are taken apart. Markers are each template's heaviest words, as many as leave
the others too light to reach the threshold, so no match is missed.

A file whose whole text matches licenses its directory (several: the most frequent, then the first name). A file
without an own notice inherits from the nearest ancestor directory that is licensed; ``path`` parts are split at '/'.

Rows: a null or empty text has no license of its own; a null path no directory. Rows that share an id are one file
whose texts count together; null ids are one file as well. Only the three named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import read, store
from martloom.session import literal_frame

THRESHOLD = 0.7
# Notices by which works are put under the common public licences.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
}
_BETWEEN = "[^a-z0-9]+"


def _words(column):
    return F.filter(F.split(F.lower(column), _BETWEEN), lambda w: w != "")


def _template_words(templates: dict[str, str]) -> dict[str, Counter]:
    return {name: Counter(w for w in re.split(_BETWEEN, text.lower()) if w) for name, text in sorted(templates.items())}


def template_weights(templates: dict[str, str], n_files: int, df: dict[str, int],
                     threshold: float = THRESHOLD) -> tuple[dict[str, float], dict[str, dict[str, float]], list[str]]:
    """idf of the template words, unit vector of each template, and the marker words."""
    counts = _template_words(templates)
    idf = {w: math.log((n_files + 1) / (df.get(w, 0) + 1)) + 1 for c in counts.values() for w in c}
    vectors, markers = {}, set()
    for name, words in counts.items():
        raw = {w: n * idf[w] for w, n in words.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vectors[name] = {w: x / norm for w, x in raw.items()}
        rest = 1.0
        for w, x in sorted(vectors[name].items(), key=lambda item: (-item[1], item[0])):
            if math.sqrt(max(0.0, rest)) < threshold * (1 - 1e-9):
                break
            markers.add(w)
            rest -= x * x
    return idf, vectors, sorted(markers)


def own_licenses(files: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(file_id, no, license, score) of all units that match; ``no`` is the line, or -1 for the whole text."""
    spark = files.sparkSession
    names = sorted(templates)
    known = sorted({w for c in _template_words(templates).values() for w in c})
    terms = literal_frame(spark, [(w,) for w in known], T.StructType([T.StructField("word", T.StringType())]))
    n_files = files.select("file_id").distinct().count()
    seen = files.select("file_id", F.explode(F.split(F.lower("text"), _BETWEEN)).alias("word"))
    df = seen.join(F.broadcast(terms), "word").distinct().groupBy("word").count().collect()  # a row per template word
    idf, vectors, markers = template_weights(templates, n_files, {r.word: r["count"] for r in df}, threshold)
    weights = literal_frame(spark, [(w, idf[w], [vectors[k].get(w, 0.0) for k in names]) for w in known], T.StructType([
        T.StructField("word", T.StringType()), T.StructField("idf", T.DoubleType()),
        T.StructField("weights", T.ArrayType(T.DoubleType()))]))
    other = math.log(n_files + 1) + 1

    marked = F.lower("text").rlike(f"(?<![a-z0-9])(?:{'|'.join(markers)})(?![a-z0-9])")
    lines = files.where(marked).select("file_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    tf = lines.select("file_id", "no", F.explode(_words("line")).alias("word")).groupBy("file_id", "no", "word").agg(
        F.count("*").alias("tf"))
    tf = store(tf, "license-words")
    whole = tf.groupBy("file_id", "word").agg(F.sum("tf").alias("tf")).select("file_id", F.lit(-1).alias("no"), "word", "tf")
    units = tf.union(whole.select(*tf.columns)).join(F.broadcast(weights), "word", "left")
    weight = F.col("tf") * F.coalesce("idf", F.lit(other))
    dots = [F.sum(weight * F.coalesce(F.get("weights", F.lit(k)), F.lit(0.0))) for k in range(len(names))]
    sums = units.groupBy("file_id", "no").agg(F.sum(weight * weight).alias("square"), F.array(*dots).alias("dots"))
    cosines = sums.select("file_id", "no", F.transform("dots", lambda d: F.round(d / F.sqrt("square"), 9)).alias("c"))
    best = F.array_max("c")
    hit = cosines.where(best >= threshold)
    name = F.get(F.array(*map(F.lit, names)), (F.array_position("c", best) - 1).cast("int"))
    return hit.select("file_id", "no", name.alias("license"), best.alias("score"))


def directory(path):
    """All but the last part of a path; null where there is none."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", ""))


def nearest_licensed(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, license, licensed_dir): for each of ``directories`` (dir) the nearest licensed one among itself and its
    ancestors, by a join with ``licensed`` (dir, license) on every prefix of the path."""
    parts = F.split("dir", "/")
    up = F.explode(F.sequence(F.lit(1), F.size(parts)))
    prefixes = directories.select("dir", up.alias("depth")).withColumn("above", F.array_join(F.slice(parts, 1, F.col("depth")), "/"))
    found = prefixes.join(licensed.withColumnRenamed("dir", "above"), "above")
    return found.groupBy("dir").agg(F.max_by(F.struct("license", "above"), "depth").alias("hit")).select(
        "dir", F.col("hit.license").alias("license"), F.col("hit.above").alias("licensed_dir"))


def scan_licenses(files: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``files`` (file_id, path, text): file_id, path, own_license, own_line, own_score, inherited_license,
    inherited_from, license (own, else inherited; null where neither)."""
    files = files.select("file_id", "path", "text")
    hits = store(own_licenses(files, templates, threshold), "license-hits")
    own = hits.where("no >= 0").groupBy("file_id").agg(F.min_by(F.struct("license", "no", "score"), F.struct(-F.col("score"), "no")).alias("own"))
    own = own.select(F.col("file_id").alias("_id"), F.col("own.license").alias("own_license"), F.col("own.no").alias("own_line"),
                     F.col("own.score").alias("own_score"))
    places = files.select("file_id", "path", directory(F.col("path")).alias("dir"))
    texts = hits.where("no = -1").select(F.col("file_id").alias("_id"), "license")
    votes = places.join(texts, F.col("file_id").eqNullSafe(F.col("_id"))).where("dir is not null").groupBy("dir", "license").count()
    licensed = votes.groupBy("dir").agg(F.min_by("license", F.struct(-F.col("count"), "license")).alias("license"))
    near = nearest_licensed(places.where("dir is not null").select("dir").distinct(), licensed).select(
        F.col("dir").alias("_dir"), F.col("license").alias("inherited_license"), F.col("licensed_dir").alias("inherited_from"))
    out = places.join(own, F.col("file_id").eqNullSafe(F.col("_id")), "left").join(near, F.col("dir") == F.col("_dir"), "left")
    return out.select("file_id", "path", "own_license", "own_line", "own_score", "inherited_license", "inherited_from",
                      F.coalesce("own_license", "inherited_license").alias("license"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all ``documents``, filed as source/lang/doc_id."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan_licenses(docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")).withColumnRenamed("file_id", "doc_id")
