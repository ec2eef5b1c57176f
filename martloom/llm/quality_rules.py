"""Quality rules: counted base rules, then a logistic regression on hashed word and character n-grams.

The base counts words, symbols, repeated lines and repeated 8-word windows of a whole text and fails a text that is
too short or repeats itself. What passes is judged by a model: the frequencies of words and word pairs, and
of 3 to 5 character n-grams, each hashed into ``BUCKETS`` buckets; a logistic regression learns their weights
from ``labels.quality``, a held-out fifth of the sample calibrates its logit to a probability (Platt's scaling),
and ``THRESHOLD`` decides. Scoring is one pass over Arrow batches without a shuffle.

The model is fitted in one task on at most ``SAMPLE_ROWS`` labelled documents, those with the least hash of their
id. Their whole texts count, but each travels as its non-empty buckets, so that the task is bounded in bytes too.

Rows: one per row of the input. A null text has no words and fails the base; a null or repeated ``doc_id`` is
scored like any other. Several labels of one document: the larger holds. Without labels of both classes
every score is the share of class 1, or ``THRESHOLD`` where there are none, which keeps all that pass the base.
Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import map_columns, read
from martloom.llm.quality import fold
from martloom.llm.words import WordHashes, mixed

BUCKETS = 4096
#: Bound of the labelled sample.
SAMPLE_ROWS = 3000
THRESHOLD = 0.5
LEAST_WORDS, WINDOW, REPEATED_PERCENT = 20, 8, 30
CHAR_SIZES = (3, 4, 5)
ROUNDS, RIDGE = 150, 1e-3
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
JUDGED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                    ("score", pa.float64())])
FEATURES = pa.schema([("label", pa.int64()), ("doc_id", pa.int64()), ("buckets", pa.binary()), ("shares", pa.binary())])
_PLACE = mixed(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
_SYMBOL = np.zeros(128, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


class Texts:
    """A batch of texts as arrays: hashes of the words and code points, with the text each belongs to."""

    def __init__(self, texts: list[str | None], cache: WordHashes):
        own = [(t or "").encode() for t in texts]
        split = [t.split() for t in own]
        self.n = len(texts)
        self.lines = [[line for line in t.split(b"\n") if line.strip()] for t in own]
        self.n_words = np.array([len(w) for w in split], np.int64)
        self.words = np.fromiter((cache[w] for words in split for w in words), np.uint64, int(self.n_words.sum()))
        self.word_text = np.repeat(np.arange(self.n), self.n_words)
        self.chars = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le"), np.uint32)
        self.char_text = np.repeat(np.arange(self.n), [len(t or "") for t in texts])

    def per_text(self, which: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(which, weights, minlength=self.n)

    def repeated_words(self) -> np.ndarray:
        """Words of each text that lie in a window of ``WINDOW`` words which the text holds more than once."""
        count = len(self.words) - WINDOW + 1
        if count <= 0:
            return np.zeros(self.n, np.int64)
        total = mixed(self.word_text[:count].astype(np.uint64))
        for i in range(WINDOW):
            total += self.words[i:i + count] * _PLACE[i]
        at = np.flatnonzero(self.word_text[:count] == self.word_text[WINDOW - 1:])
        _, which, counts = np.unique(mixed(total[at]), return_inverse=True, return_counts=True)
        at = at[counts[which] > 1]
        change = np.bincount(at, minlength=len(self.words) + 1) - np.bincount(at + WINDOW, minlength=len(self.words) + 1)
        return self.per_text(self.word_text[np.cumsum(change[:-1]) > 0])

    def counts(self) -> dict[str, list[int]]:
        """The base counts, one list each."""
        chars, space = self.chars, (self.chars == 32) | ((self.chars >= 9) & (self.chars <= 13))
        symbol = _SYMBOL[np.minimum(chars, 127)] & (chars < 128)
        return {"n_words": self.n_words.tolist(),
                "word_chars": self.per_text(self.char_text[~space]).tolist(),
                "n_symbols": self.per_text(self.char_text[symbol]).tolist(),
                "n_dup_lines": [len(lines) - len(set(lines)) for lines in self.lines],
                "n_repeat_words": self.repeated_words().tolist()}

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, bucket) of all n-grams, kind by kind; character n-grams have the buckets after those of words."""
        narrow = lambda h: (mixed(h) >> np.uint64(40)).astype(np.int64) % BUCKETS
        yield self.word_text, narrow(self.words)
        pairs = self.word_text[1:] == self.word_text[:-1]
        yield self.word_text[1:][pairs], narrow((self.words[:-1] * _PLACE[0] + self.words[1:] * _PLACE[1])[pairs])
        for size in CHAR_SIZES:
            count = max(0, len(self.chars) - size + 1)
            total = np.full(count, size, np.uint32)
            for i in range(size):
                total = total * np.uint32(0x9E3779B1) + self.chars[i:i + count]
            total ^= total >> np.uint32(15)
            inside = self.char_text[:count] == self.char_text[size - 1:] if count else np.zeros(0, bool)
            bucket = (total * np.uint32(0x85EBCA77) >> np.uint32(16)).astype(np.int64) % BUCKETS + BUCKETS
            yield self.char_text[:count][inside], bucket[inside]

    def shares(self) -> np.ndarray:
        """Per text its share of each bucket among its word and among its character n-grams."""
        counts = np.zeros(self.n * 2 * BUCKETS)
        for text, bucket in self.grams():
            counts += np.bincount(text * (2 * BUCKETS) + bucket, minlength=len(counts))
        halves = counts.reshape(self.n, 2, BUCKETS)
        halves /= np.maximum(halves.sum(axis=2, keepdims=True), 1)
        return halves.reshape(self.n, 2 * BUCKETS).astype(np.float32)

    def means(self, weights: np.ndarray) -> np.ndarray:
        """``shares() @ weights`` without the table of shares."""
        sums, sizes = np.zeros((2, self.n)), np.zeros((2, self.n))
        for kind, (text, bucket) in enumerate(self.grams()):
            half = 0 if kind < 2 else 1
            sums[half] += self.per_text(text, weights[bucket])
            sizes[half] += self.per_text(text)
        return (sums / np.maximum(sizes, 1)).sum(axis=0)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fitted(shares: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Weights, bias and calibration (slope, shift). Every fifth row calibrates, the others train."""
    held = np.arange(len(labels)) % 5 == 4
    held &= len(set(labels[held])) == 2 and len(set(labels[~held])) == 2
    x, y = shares[~held], labels[~held].astype(np.float32)
    scale = 1 / (np.sqrt((x**2).mean(axis=0)) + 1e-4)
    scale /= np.sqrt(((x * scale)**2).sum(axis=1).mean())
    w, b, step = np.zeros(x.shape[1], np.float32), 0.0, 2.0
    # accelerated gradient: rows have a mean square of 1, so the curvature is at most about a quarter
    ahead, ahead_b = w.copy(), b
    for t in range(ROUNDS):
        error = (_sigmoid(x @ (ahead * scale) + ahead_b) - y).astype(np.float32) / len(y)
        new = ahead - step * ((error @ x) * scale + RIDGE * ahead)
        new_b = ahead_b - step * float(error.sum())
        push = t / (t + 3)
        ahead, ahead_b = new + push * (new - w), new_b + push * (new_b - b)
        w, b = new, new_b
    weights = (w * scale).astype(np.float64)
    judged = held if held.any() else np.ones(len(labels), bool)
    slope, shift = calibrated(shares[judged] @ weights + b, labels[judged])
    return {"weights": weights * slope, "bias": np.array([b * slope + shift])}


def calibrated(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt's scaling: the slope and shift by which the logits give probabilities, by damped Newton steps.

    Labels are drawn in a little, by their numbers, so that separable ones leave the slope finite.
    """
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([logits, np.ones(len(logits))], axis=1)
    loss = lambda at: np.logaddexp(0, x @ at).sum() - target @ (x @ at)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ at)
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (p - target))
        size = 1.0
        while size > 1e-6 and loss(at - size * move) > loss(at):
            size /= 2
        at = at - size * move
        if np.abs(size * move).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def _sample_features():
    cache = WordHashes()

    def extract(batch: dict) -> Iterator[dict]:
        for i in range(0, len(batch["doc_id"]), 16):
            part = {k: v[i:i + 16] for k, v in batch.items()}
            shares = Texts(part["text"], cache).shares()
            held = [np.flatnonzero(row) for row in shares]
            yield {"label": part["label"], "doc_id": part["doc_id"],
                   "buckets": [at.astype(np.uint16).tobytes() for at in held],
                   "shares": [np.sqrt(row[at]).astype(np.float16).tobytes() for row, at in zip(shares, held)]}

    return extract


def _fit_task(sample: pa.Table) -> pa.Table:
    sample = sample.sort_by([("doc_id", "ascending"), ("shares", "ascending")])
    table = np.zeros((sample.num_rows, 2 * BUCKETS), np.float32)
    for row, (at, shares) in enumerate(zip(sample["buckets"], sample["shares"])):
        table[row, np.frombuffer(at.as_py(), np.uint16)] = np.frombuffer(shares.as_py(), np.float16).astype(np.float32)**2
    file = io.BytesIO()
    np.savez(file, **fitted(table, sample["label"].to_numpy()))
    return pa.table({"model": pa.array([file.getvalue()], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | float:
    """Weights and bias learned from (doc_id, label) rows with labels 0 or 1, or one score for all."""
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.max(F.col("label").cast("long")).alias("label"))
    ids = docs.select(F.col("doc_id").cast("long"), "text")
    # labels may name documents that are not there, so documents decide; ids only, at most sample_rows of them
    sample = labels.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    chosen = [(r.doc_id, r.label) for r in sample.collect()]
    positive = sum(label for _, label in chosen)
    if positive in (0, len(chosen)):
        return positive / len(chosen) if chosen else THRESHOLD
    sample = docs.sparkSession.createDataFrame(chosen, "doc_id long, label long")
    # of rows that share an id one is enough, and keeps the sample bounded
    rows = ids.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    task = map_columns(rows, _sample_features, FEATURES).withColumn("one", F.lit(1)).groupBy("one").applyInArrow(
        _fit_task, "model binary")
    with np.load(io.BytesIO(task.first().model)) as file:
        return dict(file)


def _judge(model: dict | float):
    def start():
        cache = WordHashes()

        def judge(batch: dict) -> Iterator[dict]:
            texts = Texts(batch["text"], cache)
            score = (_sigmoid(texts.means(model["weights"]) + model["bias"][0]) if isinstance(model, dict)
                     else np.full(texts.n, model))
            yield {"doc_id": batch["doc_id"], **texts.counts(), "score": score}

        return judge

    return start


def judged(docs: DataFrame, model: dict | float) -> DataFrame:
    """(doc_id, base counts, score, base_failed, kept) per row of ``docs``; ``score`` is the probability of label 1."""
    rows = map_columns(docs.select(F.col("doc_id").cast("long"), "text"), _judge(model), JUDGED)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= THRESHOLD))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and verdict of ``documents``; labels of one fold of three are not learned from."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    learned = labels.where(fold(F.col("doc_id"), 3) != 1).select("doc_id", F.col("quality").alias("label"))
    return judged(docs, fit(docs, learned)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
