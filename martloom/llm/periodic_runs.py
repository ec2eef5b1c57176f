"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of consecutive words with smallest period q and ``max(MIN_LENGTH, MIN_REPEATS * q)`` words or
more that neither neighbouring word extends. Every word of a run occurs at least ``MIN_REPEATS`` times in it, so a
word that occurs more rarely within its segment is in no run and splits the segment; what is left is split again
by its own counts until nothing changes. Most texts end there.

Surviving segments are scanned for lags. In a run of period q a window of q to 2q words occurs again exactly q
words later and no sooner, so windows of 1, 2, 4, ... words, named by doubling, propose the lags: a stretch of
starts whose next equal window is the same q away is a run, found with its exact ends, in n log n steps.

Rows: one per row of the input, whatever ``doc_id`` holds (null and repeated ids too). A null text or one without
words has no runs and an empty collapsed text. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import map_columns, read

MIN_LENGTH, MIN_REPEATS = 6, 4
RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())),
                  ("lengths", pa.list_(pa.int64())), ("periods", pa.list_(pa.int64())), ("strongest", pa.int64()),
                  ("collapsed", pa.binary())])


def surviving(text: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Segment number of each position, -1 where no run can be; ``text`` numbers the text of each position."""
    out = np.full(len(word), -1, np.int64)
    at, segment, names, used = np.arange(len(word)), text.astype(np.int64), int(word.max(initial=0)) + 1, 0
    while len(at):
        _, which, counts = np.unique(segment * names + word[at], return_inverse=True, return_counts=True)
        rare = counts[which] < MIN_REPEATS
        first = np.append(True, segment[1:] != segment[:-1])
        old = np.cumsum(first) - 1
        split = np.bincount(old, rare) > 0
        settled = ~split[old]
        out[at[settled]] = used + old[settled]
        used += len(split)
        # a rare word ends a part and belongs to none
        part = np.cumsum(first | rare)
        left = ~settled & ~rare
        at, segment = at[left], part[left]
        long_enough = np.bincount(segment, minlength=1)[segment] >= MIN_LENGTH
        at, segment = at[long_enough], segment[long_enough]
    sizes = np.bincount(out[out >= 0], minlength=1)
    out[(out >= 0) & (sizes[out] < MIN_LENGTH)] = -1
    return out


def lag_scan(segment: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs; positions of one segment stand together."""
    n = len(word)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    sizes = np.bincount(segment)[segment] if n else np.empty(0, np.int64)
    ends = np.searchsorted(segment, segment, side="right")
    _, names = np.unique(segment * (int(word.max(initial=0)) + 1) + word, return_inverse=True)
    names = names.astype(np.int64)
    starts, width = np.arange(n), 1
    while len(starts):
        order = starts[np.argsort(names[starts], kind="stable")]
        again = names[order[1:]] == names[order[:-1]]
        lag = np.zeros(n + 1, np.int64)
        lag[order[:-1][again]] = (order[1:] - order[:-1])[again]
        lag[(lag <= width // 2) | (lag > width)] = 0
        edges = np.flatnonzero(np.append(lag[0] != 0, lag[1:] != lag[:-1]))
        begin, period = edges, lag[edges]
        length = np.append(edges[1:], n) - begin - 1 + width + period
        good = (period > 0) & (length >= np.maximum(MIN_LENGTH, MIN_REPEATS * period))
        found.append((begin[good], length[good], period[good]))
        # windows twice as wide, where the segment can hold a run of a larger period
        wider = starts[(starts + 2 * width <= ends[starts]) & (sizes[starts] >= MIN_REPEATS * (width + 1))]
        _, renamed = np.unique(names[wider] * (n + 1) + names[wider + width], return_inverse=True)
        names = np.full(n, -1, np.int64)
        names[wider] = renamed
        starts, width = wider, 2 * width
    if not found:
        return starts, starts, starts
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and period; texts are lists of words."""
    numbers: dict[bytes, int] = {}
    word = np.array([numbers.setdefault(w, len(numbers)) for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    segment = surviving(text, word)
    at = np.flatnonzero(segment >= 0)
    # numbered anew in order of position
    segment = np.cumsum(np.append(0, segment[at][1:] != segment[at][:-1])) if len(at) else at
    start, length, period = lag_scan(segment, word[at])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    before = np.cumsum(sizes) - sizes
    for i, n, q in zip(at[start].tolist(), length.tolist(), period.tolist()):
        out[text[i]].append((i - int(before[text[i]]), n, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """Place of the run with the greatest length / period; the first one of equals."""
    if not runs:
        return None
    return max(range(len(runs)), key=lambda i: (Fraction(runs[i][1], runs[i][2]), -i))


def _finder():
    def find(batch: dict) -> Iterator[dict]:
        texts = [(t or b"").split() for t in batch["text"]]
        runs = runs_of(texts)
        columns = [[[r[k] for r in found] for found in runs] for k in range(3)]
        yield dict(zip(RUNS.names, [
            batch["doc_id"], [len(words) for words in texts], *columns, [_strongest(found) for found in runs],
            [b" ".join(collapsed(words, found)) for words, found in zip(texts, runs)]]))

    return find


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, starts, lengths, periods, strongest, collapsed) per row of ``docs``.

    The arrays hold the runs by start and period, ``strongest`` the place of the one with most repeats (null
    without runs), ``collapsed`` the text without the repeats, as words joined by one space.
    """
    return map_columns(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")),
                       _finder, RUNS)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where every tenth document by the crc32 of its id repeats a part of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    edited = F.expr("""array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(
        slice(words, a + 1, p), cast((n - a) div p + 1 as int))), 1, n - a)), ' ')""")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"))
    chosen = chosen.withColumn("words", F.when(F.col("g").isNotNull(), words)).withColumn("n", F.size("words"))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    chosen = chosen.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of ``documents``, a tenth of them with a part repeated, and digests of the runs and of what stays."""
    found = periodic_runs(with_repeats(read(spark, sf_dir, "documents")))
    best = lambda c: F.get(F.col(c), F.col("strongest"))
    listed = F.expr("""array_join(transform(arrays_zip(starts, lengths, periods),
        r -> concat(r.starts, ',', r.lengths, ',', r.periods, '\\n')), '')""")
    return found.select(
        "doc_id", F.size("starts").cast("long").alias("n_runs"), best("starts").alias("start"),
        best("lengths").alias("length"), best("periods").alias("period"),
        F.expr("1000 * get(lengths, strongest) div get(periods, strongest)").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
