"""MinHash near-dedup with SetSketch registers.

Every document's set of five-word shingles gives ``REGISTERS`` truncated minima: register i holds
``floor(1 + log_b(a / m_i))`` of the least of the exponential variates ``m_i`` that its shingles draw,
clipped to 16 bits. Registers of a union are the larger ones of its parts (``merged``), and equal
registers are the likelier the more two sets share. ``BANDS`` bands of ``ROWS`` registers give the
candidates; their likelihood in the Jaccard similarity, given both set sizes and how many registers
are larger, smaller or equal, drops pairs that are far below the threshold; the rest is confirmed on
full sets (of 64-bit shingle hashes).

Simulated with the bands as drawn (400,000 pairs, registers equal independently with the similarity as probability), a pair
shares no band in 7 cases at 0.85, 86 at 0.82 and 441 (about one in 900) at 0.80, the threshold of the pipeline.

Rows: an empty, null or white text has no shingles and is linked with nothing. A null ``doc_id`` gets a
null component and is kept. Rows that share a ``doc_id`` are one node: a link of one holds for all.
Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import LEAST, MARGIN, close, linked_components, map_columns, marked, read, store
from martloom.llm.words import WordHashes, mixed, shingles

REGISTERS, ROWS, BANDS = 256, 9, 64
BASE, RATE = 1.02, 20.0
#: Registers whose low bytes the second pass over buckets compares.
COMPARED = 224
SKETCHES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_1", pa.int64()),
                      ("set_2", pa.int64()), ("regs", pa.binary()), ("bands", pa.list_(pa.int64())),
                      ("low", pa.list_(pa.int64()))])
SETS = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
LEASTS = pa.schema([("id", pa.int64()), ("least", pa.list_(pa.int32()))])
_BLOCK = 2048
_SEED = np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_A = (mixed(_SEED[:REGISTERS]) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mixed(_SEED[REGISTERS:]) >> np.uint64(32)).astype(np.uint32)
_DRAWN = np.stack([np.random.default_rng(i).choice(REGISTERS, ROWS, replace=False) for i in range(BANDS)])
_BAND_MULT = mixed(np.arange(101, 101 + BANDS * ROWS, dtype=np.uint64)).reshape(BANDS, ROWS) | np.uint64(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of 64-bit hashes."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(x), _BLOCK):
        drawn = x[None, i:i + _BLOCK] * _A[:, None]
        drawn += _B[:, None]
        np.minimum(least, drawn.min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**32
    exponential = -np.log1p(-uniform)
    return np.clip(np.floor(1 + np.log(RATE / exponential) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merged(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(left, right)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per band."""
    rows = regs[_DRAWN].astype(np.uint64) + np.uint64(1)
    return mixed((rows * _BAND_MULT).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def low_bytes(regs: np.ndarray) -> np.ndarray:
    """Low bytes of the first ``COMPARED`` registers, seven to a signed 64-bit value."""
    out = np.zeros((COMPARED // 7, 8), np.uint8)
    out[:, :7] = regs[:COMPARED].astype(np.uint8).reshape(-1, 7)
    return out.view(np.int64)[:, 0]


def _equal_bytes(a: str, b: str) -> Column:
    """Number of equal low bytes of two columns of ``low_bytes``."""
    sevens, high = F.lit(0x007F7F7F7F7F7F7F), F.lit(0x0080808080808080)

    def unequal(differs: Column) -> Column:
        # the high bit of a byte stays unset where the byte is zero
        some = (differs.bitwiseAND(sevens) + sevens).bitwiseOR(differs)
        return F.bit_count(some.bitwiseAND(high))

    # by a function of each word: spelt out, a join's generated code is too long for the JVM to compile
    words = F.zip_with(F.col(a), F.col(b), lambda x, y: x.bitwiseXOR(y))
    return F.aggregate(words, F.lit(COMPARED), lambda total, word: total - unequal(word))


def likeliest(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimates of the Jaccard similarity, one per row of registers."""
    above = (left > right).sum(axis=1)[:, None]
    below = (left < right).sum(axis=1)[:, None]
    equal = left.shape[1] - above - below
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    j = np.linspace(0, 1, 201)[None, :] * top
    moved = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    tiny = 1e-12
    up, down = moved(u - v * j), moved(v - u * j)
    score = (above * np.log(np.maximum(up, tiny)) + below * np.log(np.maximum(down, tiny))
             + equal * np.log(np.maximum(1 - up - down, tiny)))
    return np.take_along_axis(j, score.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketcher():
    cache, place = WordHashes(), np.uint64(0x9E3779B97F4A7C15)

    def sketch(batch: dict) -> Iterator[dict]:
        out = {name: [] for name in SKETCHES.names}
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            s = shingles(text or b"", cache)
            row = (doc_id, 0, 0, 0, None, None, None)
            if len(s):
                first = int(s.sum(dtype=np.uint64).view(np.int64))
                second = int(np.bitwise_xor.reduce(mixed(s * place)).view(np.int64))
                regs = registers(s)
                row = (doc_id, len(s), first, second, regs.tobytes(), band_keys(regs), low_bytes(regs))
            for name, value in zip(SKETCHES.names, row):
                out[name].append(value)
        yield out

    return sketch


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_1, set_2, regs, bands); (set_1, set_2) names the exact set."""
    return map_columns(_documents(docs), _sketcher, SKETCHES)


def _set_maker():
    cache = WordHashes()

    def make(batch: dict) -> Iterator[dict]:
        yield {"id": batch["doc_id"], "shingles": [shingles(t or b"", cache).view(np.int64) for t in batch["text"]]}

    return make


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(id, shingles): full sets as arrays of distinct 64-bit hashes."""
    return map_columns(_documents(docs), _set_maker, SETS)


def _least_maker():
    cache = WordHashes()

    def least(text: bytes | None) -> np.ndarray:
        return np.unique(shingles(text or b"", cache).astype(np.uint32).view(np.int32))[:LEAST]

    def make(batch: dict) -> Iterator[dict]:
        yield {"id": batch["doc_id"], "least": [least(t) for t in batch["text"]]}

    return make


def least_hashes(docs: DataFrame) -> DataFrame:
    """(id, least): the ``LEAST`` smallest 32-bit shingle hashes, in order; the whole set of a text that has fewer."""
    return map_columns(_documents(docs), _least_maker, LEASTS)


def _hopeful(percent: int):
    limit = percent / 100
    least = limit - MARGIN * (limit * (1 - limit) / REGISTERS) ** 0.5

    @F.pandas_udf("boolean")
    def hopeful(ra: pd.Series, rb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(ra):
            return pd.Series([], dtype=bool)
        left = np.frombuffer(b"".join(ra), np.uint16).reshape(-1, REGISTERS)
        right = np.frombuffer(b"".join(rb), np.uint16).reshape(-1, REGISTERS)
        return pd.Series(likeliest(left, right, na.to_numpy(float), nb.to_numpy(float)) >= least)

    return hopeful


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Rows with 100 * |intersection| >= percent * |union| of their shingle sets are linked;
    ``component_id`` is the smallest doc_id reachable, ``kept`` tells whether it is the row's own.
    Equal sets are one class from the start, so copies are never compared with one another.
    """
    drawn = store(sketches(docs), "sketches")
    own = drawn.where("n_shingles > 0 and doc_id is not null")
    classes = own.groupBy("set_1", "set_2", "n_shingles").agg(F.min("doc_id").alias("class_id"))
    classes = store(classes, "classes")
    heads = own.join(classes.select(F.col("class_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    heads = heads.select(F.col("doc_id").alias("id"), "n_shingles", "regs", "bands", "low")
    buckets = heads.select("id", F.explode("bands").alias("key")).select("key", "id").distinct()

    def texts_of(wanted: DataFrame) -> DataFrame:
        near_docs = marked(docs.select("doc_id", "text"), "doc_id", wanted).where("maybe")
        return near_docs.join(wanted, "doc_id", "left_semi")

    def verify(pairs: DataFrame) -> DataFrame:
        side = lambda s: heads.select(F.col("id").alias(s), F.col("regs").alias(f"r{s}"),
                                      F.col("n_shingles").alias(f"n{s}"))
        # sizes alone bound the similarity: |A and B| / |A or B| <= smaller / larger
        near = pairs.join(side("a"), "a").join(side("b"), "b").where(
            100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        near = store(near.where(_hopeful(percent)("ra", "rb", "na", "nb")).select("a", "b").distinct(), "hopeful")
        sets = store(shingle_sets(texts_of(near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())), "sets")
        full = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        both = F.size(F.array_intersect("sa", "sb"))
        return full.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct()

    limit = percent / 100
    least = COMPARED * limit - MARGIN * (COMPARED * limit * (1 - limit)) ** 0.5

    def likely(a: str, b: str) -> Column:
        sizes = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
        return ((100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (_equal_bytes(f"{a}low", f"{b}low") >= least)
                & close(f"{a}least", f"{b}least", percent))

    def traits(ids: DataFrame) -> DataFrame:
        # rows that share a doc_id have all their sets; any two of them may be the close ones
        texts = texts_of(ids.withColumnRenamed("id", "doc_id"))
        return heads.select("id", "n_shingles", "low").join(store(least_hashes(texts).distinct(), "least"), "id")

    named = linked_components(buckets, verify, "near", traits, likely)
    # rows sharing a doc_id are one node: join the classes through it
    labels = classes.join(named.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "set_1", "set_2", "n_shingles", F.coalesce("component", "class_id").alias("class_component"))
    rows = drawn.select("doc_id", "n_shingles", "set_1", "set_2").join(
        labels, ["set_1", "set_2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of ``documents`` at a similarity of 0.85."""
    return near_duplicates(read(spark, sf_dir, "documents"), 85)


ORACLE_SQL = """
with recursive worded as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
    from documents),
sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(
        list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from worded),
sizes as (select doc_id, len(s)::bigint as n from sets),
shingle as (select doc_id, unnest(s) as s from sets),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from shingle as x join shingle as y on x.s = y.s and x.doc_id < y.doc_id group by all),
links as (
    select a, b from shared join sizes as x on x.doc_id = a join sizes as y on y.doc_id = b
    where 100 * common >= 85 * (x.n + y.n - common)),
neighbours as (select a as id, b as other from links union all select b, a from links),
reach as (
    select a as id, a as other from links union select b, b from links
    union select r.id, n.other from reach as r join neighbours as n on n.id = r.other),
components as (select id, min(other) as component from reach group by id)
select doc_id, n as n_shingles, coalesce(component, doc_id) as component_id, coalesce(component, doc_id) = doc_id as kept
from sizes left join components on id = doc_id
"""
