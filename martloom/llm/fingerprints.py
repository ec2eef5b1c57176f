"""Document fingerprints: one-permutation MinHash, densified, stored as packed low-order bits.

Five-word shingles are hashed once; the leading bits of a hash choose one of ``BINS`` bins and the least hash
of each bin counts. An empty bin takes the value of a filled one, found by a fixed random sequence of bins
of its own (optimal densification). ``BITS`` low-order bits of each bin's value, mixed anew, are packed.
Two bins agree by chance in 2**-BITS of all cases, which ``likeness`` takes out again.

``edited_fingerprints`` compares every document with an edited form of itself and with the next document.
Documents are dealt into ranges of descending doc_id, so the next document is the next row of a task; only
the last row of a range waits for the head of the next one, and one row per range is all that is joined.

Rows: a null text is empty. A text without words has the empty fingerprint, like (1.0) only another such. Rows
come in descending doc_id, then by text; null ids come last. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import map_columns, read, store
from martloom.llm.words import WordHashes, mixed, shingles

BINS, BITS = 256, 4
_SHIFT = np.uint64(64 - 8)
_TRIES = 64
COMPARED = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
RESULT = pa.schema(COMPARED)
#: Rows of a range: "row" is complete, "head" is its first document, "last" waits for the next range.
RANGED = pa.schema([("part", pa.int32()), ("kind", pa.string()), ("text", pa.string()), *COMPARED])


def bin_values(hashes: np.ndarray) -> np.ndarray:
    """The value of every bin, from a sorted, non-empty array of distinct hashes."""
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    values, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], full[bins[first]] = hashes[first], True
    filled = values.copy()
    empty, block = np.flatnonzero(~full), 0
    while len(empty):
        tries = np.arange(block * _TRIES, (block + 1) * _TRIES, dtype=np.uint64)[:, None] * np.uint64(BINS)
        donors = (mixed(tries + empty.astype(np.uint64)[None, :] + np.uint64(1)) >> _SHIFT).astype(np.int64)
        hit = full[donors]
        found = hit.any(axis=0)
        filled[empty[found]] = values[donors[hit.argmax(axis=0)[found], np.flatnonzero(found)]]
        empty, block = empty[~found], block + 1
    return filled


def fingerprint(text: str, cache: WordHashes) -> bytes:
    """Packed low-order bits; no bytes if the text has no words."""
    s = shingles(text.encode(), cache)
    if not len(s):
        return b""
    low = (mixed(bin_values(s)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return (low[0::2] | low[1::2] << BITS).tobytes()


def likeness(left: bytes, right: bytes) -> float:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    if not left or not right:
        return float(left == right)
    a, b = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    same = ((a ^ b) & 15 == 0).sum() + ((a ^ b) >> 4 == 0).sum()
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, (same / BINS - chance) / (1 - chance))))


def _compared(doc_id, text: str, own: bytes, after: str, after_own: bytes, cache: WordHashes) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    print_ = own if edited == text else fingerprint(edited, cache)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), print_.hex(),
            likeness(own, print_), likeness(own, after_own))


def _ranger():
    cache, part, before = WordHashes(), TaskContext.get().partitionId(), []
    blank = (None,) * len(COMPARED)

    def columns(rows: list[tuple]) -> dict:
        return {n: [r[i] for r in rows] for i, n in enumerate(RANGED.names)}

    def follow(batch: dict) -> Iterator[dict]:
        out = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            text = text or ""
            own = fingerprint(text, cache)
            if before:
                out.append((part, "row", None, *_compared(*before[0], text, own, cache)))
            else:
                out.append((part, "head", text, *blank))
            before[:] = [(doc_id, text, own)]
        yield columns(out)

    def last() -> Iterator[dict]:
        for doc_id, text, own in before:
            yield columns([(part, "last", text, doc_id, *blank[1:])])

    return follow, last


def _joiner():
    cache = WordHashes()

    def join(batch: dict) -> Iterator[dict]:
        rows = []
        for doc_id, text, after in zip(batch["doc_id"], batch["text"], batch["after"]):
            rows.append(_compared(doc_id, text, fingerprint(text, cache), after, fingerprint(after, cache), cache))
        yield {n: [r[i] for r in rows] for i, n in enumerate(RESULT.names)}

    return join


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the next document
    in descending doc_id; after the last document comes the first.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")]
    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(F.desc_nulls_last("doc_id"))
    ranged = store(map_columns(rows.sortWithinPartitions(*order), _ranger, RANGED), "ranged")
    heads = ranged.where("kind = 'head'")
    # one row per range: numbers of the ranges that have rows, each with the next one's, and the first after the last
    parts = heads.select("part")
    after = parts.select("part", F.lead("part").over(Window.orderBy("part")).alias("next_part")).crossJoin(
        F.broadcast(parts.agg(F.min("part").alias("first_part")))).select("part", F.coalesce("next_part", "first_part").alias("next_part"))
    ends = ranged.where("kind = 'last'").select("part", "doc_id", "text").join(after, "part").join(
        heads.select(F.col("part").alias("next_part"), F.col("text").alias("after")), "next_part")
    joined = map_columns(ends.select("doc_id", "text", "after"), _joiner, RESULT)
    return ranged.where("kind = 'row'").select(*RESULT.names).union(joined)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    return edited_fingerprints(read(spark, sf_dir, "documents"))
