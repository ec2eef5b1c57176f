"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages (``PASSAGE_BYTES`` each, whole text). A passage is encoded from its byte
and hashed byte-pair frequencies and its share of distinct pairs; a gated attention
``softmax(w . (tanh(V h) * sigmoid(U h)))`` over the bag weighs the encodings, and a logistic unit scores
their weighted mean. Labels exist for documents only, so attention learns which passages decide.

The classifier is fitted on at most ``SAMPLE_ROWS`` labelled documents, those with the least hash of
their id, in one task; its weights (some 150 KB) go to all tasks. Everything is then scored in one
pass over the table, without a shuffle.

Rows: null and empty texts are one empty passage. A null ``doc_id`` is scored and counts as not held out.
Several labels of one document: the larger holds. Labels of one class only, or none: every score is the
share of class 1, or 0.5.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import map_columns, read

PASSAGE_BYTES = 512
#: Bound of the labelled sample that the classifier is fitted on.
SAMPLE_ROWS = 6000
PAIR_BUCKETS = 767
FEATURES = 256 + PAIR_BUCKETS + 1
HIDDEN, GATE = 32, 16
EPOCHS, BATCH_DOCS, STEP = 8, 64, 0.01
SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
_BLOCK_PASSAGES = 256


def passage_features(text: bytes, first: int, last: int) -> np.ndarray:
    """Features of the passages ``first`` to ``last`` (exclusive) of a text, one row each."""
    own = np.frombuffer(text, np.uint8)[first * PASSAGE_BYTES:last * PASSAGE_BYTES].astype(np.int64)
    rows = max(1, last - first)
    if not len(own):
        return np.zeros((rows, FEATURES), np.float32)
    row = np.arange(len(own)) // PASSAGE_BYTES * FEATURES
    pair = 256 + (own[:-1] * 31 + own[1:] * 257) % PAIR_BUCKETS
    counts = (np.bincount(row + own, minlength=rows * FEATURES)
              + np.bincount(row[1:] + pair, minlength=rows * FEATURES)).reshape(rows, FEATURES)
    length = np.maximum(counts[:, :256].sum(axis=1, keepdims=True), 1)
    out = np.sqrt(counts / length, dtype=np.float32)
    out[:, -1] = (counts[:, 256:] > 0).sum(axis=1) / length[:, 0]
    return out


def _passages(text: bytes) -> int:
    return max(1, -(-len(text) // PASSAGE_BYTES))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fitted(features: np.ndarray, starts: np.ndarray, labels: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights by Adam on the log loss; ``starts`` is each bag's first row in ``features``."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / shape[0] ** 0.5).astype(np.float32)
    p = {"W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, GATE),
         "U": draw(HIDDEN, GATE), "w": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(1, np.float32)}
    m = {k: np.zeros_like(x) for k, x in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    ends, t = np.append(starts[1:], len(features)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(starts))
        for i in range(0, len(order), BATCH_DOCS):
            bags = order[i:i + BATCH_DOCS]
            sizes = ends[bags] - starts[bags]
            at = np.append(0, np.cumsum(sizes)[:-1])
            x = features[np.concatenate([np.arange(starts[b], ends[b]) for b in bags])]
            bag = np.repeat(np.arange(len(bags)), sizes)
            h = np.tanh(x @ p["W"] + p["b"])
            left, gate = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
            e = (left * gate) @ p["w"]
            a = np.exp(e - np.maximum.reduceat(e, at)[bag])
            a /= np.add.reduceat(a, at)[bag]
            z = np.add.reduceat(a[:, None] * h, at)
            dy = (_sigmoid(z @ p["c"] + p["d"]) - labels[bags]) / len(bags)
            dz = dy[:, None] * p["c"]
            da = (dz[bag] * h).sum(axis=1)
            de = a * (da - np.add.reduceat(a * da, at)[bag])
            dg = de[:, None] * p["w"]
            dl, dr = dg * gate * (1 - left**2), dg * left * gate * (1 - gate)
            dh = (a[:, None] * dz[bag] + dl @ p["V"].T + dr @ p["U"].T) * (1 - h**2)
            grads = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dl, "U": h.T @ dr,
                     "w": (left * gate).T @ de, "c": z.T @ dy, "d": dy.sum(keepdims=True)}
            t += 1
            for k, g in grads.items():
                g = g + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= (STEP * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return p


def score_text(text: bytes, p: dict[str, np.ndarray]) -> float:
    """The model's score of a whole text; attention is summed block by block, so memory is bounded."""
    total, weight, top = np.zeros(HIDDEN), 0.0, -np.inf
    n = _passages(text)
    for i in range(0, n, _BLOCK_PASSAGES):
        h = np.tanh(passage_features(text, i, min(n, i + _BLOCK_PASSAGES)) @ p["W"] + p["b"])
        e = (np.tanh(h @ p["V"]) * _sigmoid(h @ p["U"])) @ p["w"]
        new = max(top, float(e.max()))
        keep, a = np.exp(top - new), np.exp(e - new)
        total, weight, top = total * keep + a @ h, weight * keep + a.sum(), new
    return float(_sigmoid(total / weight @ p["c"] + p["d"])[0])


def _fit_task(sample: pa.Table) -> pa.Table:
    rows = sample.sort_by("doc_id").to_pydict()
    blocks = [passage_features(t or b"", 0, _passages(t or b"")) for t in rows["text"]]
    starts = np.cumsum([0, *(len(b) for b in blocks[:-1])])
    file = io.BytesIO()
    np.savez(file, **fitted(np.concatenate(blocks), starts, np.array(rows["label"], np.float32)))
    return pa.table({"model": pa.array([file.getvalue()], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | float:
    """Weights learned from (doc_id, label) rows with labels 0 or 1, or one score for all."""
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.max(F.col("label").cast("int")).alias("label"))
    ids = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    # labels may name documents that are not there, so documents decide; ids only, at most sample_rows of them
    sample = labels.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    chosen = [(r.doc_id, r.label) for r in sample.collect()]
    positive = sum(label for _, label in chosen)
    if positive in (0, len(chosen)):
        return positive / len(chosen) if chosen else 0.5
    sample = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int")
    task = ids.join(F.broadcast(sample), "doc_id").withColumn("one", F.lit(1)).groupBy("one").applyInArrow(
        _fit_task, "model binary")
    with np.load(io.BytesIO(task.first().model)) as file:
        return dict(file)


def _scorer(model: dict | float):
    def start():
        def score(batch: dict) -> Iterator[dict]:
            known = not isinstance(model, dict)
            yield {"doc_id": batch["doc_id"],
                   "score": [model if known else score_text(t or b"", model) for t in batch["text"]]}

        return score

    return start


def quality_scores(docs: DataFrame, model: dict | float) -> DataFrame:
    """(doc_id, score) per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return map_columns(rows, _scorer(model), SCORES)


def score_column(model: dict | float):
    """The score as a function of a binary text column, for filters that keep all other columns."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        known = not isinstance(model, dict)
        return pd.Series([model if known else score_text(t or b"", model) for t in text], dtype=float)

    return score


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def learned(docs: DataFrame, labels: DataFrame) -> dict | float:
    """The classifier of ``labels.quality`` from the rows that are not held out."""
    return fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1).select("doc_id", F.col("quality").alias("label")))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    scores = quality_scores(docs, learned(docs, read(spark, sf_dir, "labels")))
    return scores.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
