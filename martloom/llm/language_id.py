"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities of the pieces of a fixed public vocabulary. A text's likelihood is the product
over its words of the sum over all segmentations of the word into pieces, which the forward algorithm
computes. Piece probabilities come from expectation-maximisation (forward-backward counts) on a bounded
sample per language. The most likely language is predicted, its posterior under equal priors is the score.

Words are runs of letters of the lower-cased text behind a word-start mark. A letter no piece covers is a piece
of its own with a fixed small probability, equal in all languages.

Rows: a null text or one without letters is ``und`` with score 0. Without any learned language all are. Rows are
scored one by one, so repeated rows get equal results; a null ``doc_id`` is scored as well and counts as not held out.
Of equally likely languages the first in alphabetical order is predicted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import map_columns, marked, read, store
from martloom.llm.quality import fold

#: Bound of the sample per language that piece probabilities are learned from.
SAMPLE_ROWS = 500
ITERATIONS = 3
SMOOTHING = 0.01
UNKNOWN = 1e-8
_MARK = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")
#: Words whose scores a task keeps; words that texts wait for; words of a text, and distinct words, at a time.
_CACHE_ROWS, _WAIT, _PART, _BLOCK = 300_000, 200_000, 50_000, 20_000
_LOW, _LIFT = 1e-200, 1e200
PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def vocabulary(name: str = "piece_bpe_32k.model") -> list[str]:
    """Pieces of lower-case letters, with or without the word-start mark, in the order of the file."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    pieces = dict.fromkeys(model.id_to_piece(i) for i in range(model.get_piece_size()))
    bare = lambda p: p[1:] if p[0] == _MARK else p
    return [p for p in pieces if p == _MARK or _LETTERS.fullmatch(bare(p)) and bare(p) == bare(p).lower()]


def piece_table(pieces: list[str]) -> dict[str, int]:
    """Piece -> number, and every proper prefix of a piece that is none itself -> -1."""
    table = {p[:k]: -1 for p in pieces for k in range(1, len(p))}
    table.update((p, i) for i, p in enumerate(pieces))
    return table


def spans(word: str, table: dict[str, int]) -> list[tuple[int, int, int]]:
    """(start, end, piece) of all pieces in a word; -1 stands for a single letter that no piece covers."""
    out = []
    for i in range(len(word)):
        single = table.get(word[i], -1)
        if single < 0:
            out.append((i, i + 1, -1))
        else:
            out.append((i, i + 1, single))
        for j in range(i + 2, len(word) + 1):
            piece = table.get(word[i:j])
            if piece is None:
                break
            if piece >= 0:
                out.append((i, j, piece))
    return out


def word_log_likelihood(word: str, table: dict[str, int], rows: list[tuple[float, ...]], languages: int) -> list[float]:
    """Log of the sum over all segmentations, per language. ``rows``: a piece's probabilities, unknown ones last."""
    mark = _MARK + word
    every, end = range(languages), len(mark)
    ahead: dict[int, list[float]] = {0: [1.0] * languages}
    logs = [0.0] * languages
    for i in range(end):
        here = ahead.pop(i)
        if max(here) < _LOW:  # lift what is pending, language by language
            for k in every:
                if here[k] < _LOW:
                    here[k] *= _LIFT
                    logs[k] -= math.log(_LIFT)
                    for later in ahead.values():
                        later[k] *= _LIFT
        j = i + 1
        piece = table.get(mark[i], -1)
        while piece is not None:
            if piece >= 0 or j == i + 1:
                row = rows[piece]
                into = ahead.get(j)
                if into is None:
                    ahead[j] = [h * r for h, r in zip(here, row)]
                else:
                    for k in every:
                        into[k] += here[k] * row[k]
            j += 1
            if j > end:
                break
            piece = table.get(mark[i:j])
    return [logs[k] + math.log(max(ahead[end][k], 1e-320)) for k in every]


class Forward:
    """``word_log_likelihood`` of many short words at once, as arrays over the words of equal position.

    The prefixes of all pieces are the nodes of a tree; (node, letter) is looked up in a sorted array.
    """

    #: Up to this many letters a product of probabilities cannot underflow.
    LETTERS = 24

    def __init__(self, table: dict[str, int], rows: np.ndarray):
        """``rows``: (piece, language) probabilities, those of unknown letters last."""
        nodes = {"": 0} | {prefix: n for n, prefix in enumerate(table, 1)}
        letters = {c: n for n, c in enumerate(sorted(set("".join(table))), 1)}
        self.letter = np.zeros(0x110000, np.int64)
        self.letter[[ord(c) for c in letters]] = list(letters.values())
        self.base, self.rows = len(letters) + 1, rows
        steps = np.array([nodes[p[:-1]] * self.base + letters[p[-1]] for p in table], np.int64)
        order = np.argsort(steps)
        self.steps, self.child = steps[order], order + 1
        self.piece = np.array([-1, *table.values()], np.int64)

    def _next(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Children, 0 where there are none."""
        step = node * self.base + letter
        at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
        return np.where((self.steps[at] == step) & (letter > 0), self.child[at], 0)

    def __call__(self, words: list[str]) -> np.ndarray:
        """(word, language) log likelihoods; no word has more than ``LETTERS`` letters."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        back = np.argsort(-lengths, kind="stable")
        lengths = lengths[back]  # the longest first: words that reach a position are the first ones
        text = "".join(_MARK + words[k] for k in back.tolist())
        codes, longest = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)], int(lengths[0])
        letters = np.zeros((longest, len(words)), np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        letters[np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths), word] = codes
        ahead = np.zeros((longest + 1, len(words), self.rows.shape[1]))
        ahead[0] = 1.0
        for i in range(longest):
            alive = np.arange(np.searchsorted(-lengths, -i))
            here = ahead[i]
            node = self._next(np.zeros(len(alive), np.int64), letters[i, alive])
            ahead[i + 1, alive] += here[alive] * self.rows[self.piece[node]]
            for j in range(i + 1, longest):
                more = (node > 0) & (lengths[alive] > j)
                alive = alive[more]
                if not len(alive):
                    break
                node = self._next(node[more], letters[j, alive])
                piece = self.piece[node]
                whole = piece >= 0
                ahead[j + 1, alive[whole]] += here[alive[whole]] * self.rows[piece[whole]]
        out = np.empty((len(words), self.rows.shape[1]))
        out[back] = np.log(ahead[lengths, np.arange(len(words))])
        return out


def expected_counts(words: Counter, table: dict[str, int], probabilities: np.ndarray) -> np.ndarray:
    """Expected number of uses of every piece under all segmentations of the words."""
    counts = np.zeros(len(probabilities))
    p = [*probabilities.tolist(), UNKNOWN]
    for word, times in words.items():
        mark = _MARK + word
        found = spans(mark, table)
        if len(word) > Forward.LETTERS:
            for (i, j, piece), share in zip(found, _log_shares(len(mark), found, p)):
                if piece >= 0:
                    counts[piece] += times * share
            continue
        before, after = [0.0] * (len(mark) + 1), [0.0] * (len(mark) + 1)
        before[0], after[-1] = 1.0, 1.0
        for i, j, piece in found:
            before[j] += before[i] * p[piece]
        for i, j, piece in reversed(found):
            after[i] += after[j] * p[piece]
        for i, j, piece in found:
            if piece >= 0:
                counts[piece] += times * before[i] * p[piece] * after[j] / after[0]
    return counts


def _log_shares(end: int, found: list[tuple[int, int, int]], p: list[float]) -> list[float]:
    """Probability that a segmentation uses each of the spans, by logarithms: products over a long word underflow."""
    before, after = np.full(end + 1, -np.inf), np.full(end + 1, -np.inf)
    before[0] = after[end] = 0.0
    for i, j, piece in found:
        before[j] = np.logaddexp(before[j], before[i] + math.log(p[piece]))
    for i, j, piece in reversed(found):
        after[i] = np.logaddexp(after[i], after[j] + math.log(p[piece]))
    return [math.exp(before[i] + math.log(p[piece]) + after[j] - after[0]) for i, j, piece in found]


def _learn(key: tuple, sample: pa.Table) -> pa.Table:
    pieces = vocabulary()
    table, words = piece_table(pieces), Counter()
    for text in sample["text"].to_pylist():
        words.update(_LETTERS.findall((text or "").lower()))
    p = np.full(len(pieces), 1 / len(pieces))
    for _ in range(ITERATIONS):
        counts = expected_counts(words, table, p) + SMOOTHING
        p = counts / counts.sum()
    return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "p": pa.array([p.tobytes()], pa.binary())})


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Piece probabilities per language from (doc_id, text, lang), ``sample_rows`` documents of each at most."""
    known = docs.where("doc_id is not null and lang is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample_rows)
    ids = store(ids.select("doc_id", "lang").distinct(), "sample")
    near = marked(known.select("doc_id", "lang", "text"), "doc_id", ids.select("doc_id")).where("maybe").drop("maybe")
    sample = near.join(ids, ["doc_id", "lang"])
    rows = sample.groupBy("lang").applyInArrow(_learn, "lang string, p binary").collect()
    return {r.lang: np.frombuffer(r.p) for r in sorted(rows)}


def _predictor(model: dict[str, np.ndarray]):
    langs = sorted(model)

    def start():
        table = piece_table(vocabulary())
        rows = np.vstack([np.stack([model[k] for k in langs], axis=1), np.full((1, len(langs)), UNKNOWN)])
        forward, plain = Forward(table, rows), [tuple(r) for r in rows.tolist()]
        place: dict[str, int] = {}
        scores = np.empty((_CACHE_ROWS, len(langs)))
        # texts wait until they have some words together, so that the arrays are long
        waiting: list[tuple[int | None, list[str]]] = []
        n_waiting = 0

        def learn(words: Iterable[str]) -> None:
            new = [w for w in dict.fromkeys(words) if w not in place]
            if len(place) + len(new) > _CACHE_ROWS:
                place.clear()
                new = list(dict.fromkeys(words))
            short = [w for w in new if len(w) <= Forward.LETTERS]
            long = [w for w in new if len(w) > Forward.LETTERS]
            first = len(place)
            place.update((w, first + k) for k, w in enumerate([*short, *long]))
            for k in range(0, len(short), _BLOCK):
                scores[first + k:first + min(k + _BLOCK, len(short))] = forward(short[k:k + _BLOCK])
            for w in long:
                scores[place[w]] = word_log_likelihood(w, table, plain, len(langs))

        def flush() -> Iterator[dict]:
            totals = np.zeros((len(waiting), len(langs)))
            parts = [(n, words[i:i + _PART]) for n, (_, words) in enumerate(waiting) for i in range(0, len(words), _PART)]
            while parts:
                size = taken = 0
                while taken < len(parts) and size + len(parts[taken][1]) <= _WAIT:
                    size += len(parts[taken][1])
                    taken += 1
                group, parts = parts[:taken], parts[taken:]
                learn([w for _, words in group for w in words])
                for n, words in group:
                    totals[n] += scores[np.fromiter(map(place.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = totals.argmax(axis=1)
            odds = np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1) if len(waiting) else totals
            yield {"doc_id": [i for i, _ in waiting],
                   "lang_pred": [langs[k] if words else "und" for k, (_, words) in zip(best.tolist(), waiting)],
                   "score": [1 / o if words else 0.0 for o, (_, words) in zip(odds.tolist(), waiting)]}
            waiting.clear()

        def predict(batch: dict) -> Iterator[dict]:
            nonlocal n_waiting
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = _LETTERS.findall((text or "").lower())
                waiting.append((doc_id, words))
                n_waiting += len(words)
                if n_waiting >= _WAIT or len(waiting) >= _WAIT:
                    n_waiting = 0
                    yield from flush()

        def last() -> Iterator[dict]:
            if waiting:
                yield from flush()

        return predict, last

    return start


def predicted(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) per row."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if not model:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return map_columns(rows, _predictor(model), PREDICTED)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of ``documents``, learned from three of four parts of them."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.where(fold(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))
    out = predicted(docs, model)
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
