import math
import zlib
from collections import Counter

import numpy as np

from martloom.llm import language_id as li
from martloom.llm import quality as q
from tests.conftest import DATA
from tests.llm.helpers import docs


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_on_held_out_documents(spark):
    out = {r.doc_id: r for r in q.op8_quality_classifier(spark, DATA).collect()}
    assert len(out) == 1000 and all(r.held_out == (crc(i, 3) == 1) for i, r in out.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    held = [(r.quality, out[r.doc_id].predicted) for r in labels if r.quality is not None and crc(r.doc_id, 3) == 1]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_quality_edges(spark):
    good, bad = "some plain words that read well. " * 20, "B@D!! " * 90
    rows = [(i, good if i % 2 else bad) for i in range(60)] + [(100, None), (101, ""), (None, good), (102, good * 2000), (3, good)]
    table = docs(spark, rows, extra="score")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1), (None, 1), (7, None)], "doc_id long, quality int")
    model = q.learned(table, labels)
    got = {r.doc_id: r.score for r in q.quality_scores(table, model).collect()}
    assert len(got) == 64 and got[102] > 0.5 and got[None] > 0.5 and got[1] > 0.5 > got[2] and 0 <= got[100] == got[101] <= 1
    assert q.learned(table, labels.where("quality = 1")) == 1.0
    assert q.learned(table, labels.limit(0)) == 0.5
    assert q.quality_scores(docs(spark, []), model).count() == 0


def test_languages_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    out = li.op6_language_id(spark, DATA).collect()
    assert len(out) == 1000 and all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.98


def test_language_edges(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "die katze sass auf der matte", "de"), (3, None, "en"), (4, "1234 !?", "de"),
            (5, "the dog", None), (None, "auf der", "de"), (6, "x" * 30_000, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.predicted(table, li.fit(table)).collect()}
    assert got[1][0] == got[5][0] == "en" and got[2][0] == got[None][0] == "de" and got[3] == got[4] == ("und", 0.0)
    assert got[6][0] in ("en", "de") and 0 < got[6][1] <= 1
    assert {r.lang_pred for r in li.predicted(table, {}).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    table = li.piece_table(["▁", "▁a", "a", "b", "ab", "▁ab"])
    p = [0.1, 0.2, 0.3, 0.15, 0.05, 0.25]
    rows = [(x,) for x in p] + [(li.UNKNOWN,)]
    want = 0.1 * 0.3 * 0.15 + 0.1 * 0.05 + 0.2 * 0.15 + 0.25  # ▁|a|b, ▁|ab, ▁a|b, ▁ab
    assert abs(li.word_log_likelihood("ab", table, rows, 1)[0] - math.log(want)) < 1e-12
    long = li.word_log_likelihood("ab" * 5000, table, rows, 1)[0]
    assert abs(long / 5000 - li.word_log_likelihood("ab" * 2000, table, rows, 1)[0] / 2000) < 0.01


def pieces_of(word):
    """All segmentations of a word."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in pieces_of(word[k:]):
            yield [word[:k], *rest]


def plain_likelihood(word, pieces, p):
    """Sum over all segmentations; letters no piece covers have the probability of unknown ones."""
    total = 0.0
    for parts in pieces_of("▁" + word):
        x = 1.0
        for part in parts:
            x *= p[pieces.index(part)] if part in pieces else li.UNKNOWN if len(part) == 1 else 0.0
        total += x
    return total


def test_forward_of_many_words_equals_an_enumeration():
    rng = np.random.default_rng(1)
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "bab", "abba", "ça", "▁ç"]
    p = rng.dirichlet(np.ones(len(pieces)), 3).T
    rows = np.vstack([p, np.full((1, 3), li.UNKNOWN)])
    table = li.piece_table(pieces)
    words = ["".join(rng.choice(list("abçx"), n)) for n in [*range(1, 11)] * 5]
    got = li.Forward(table, rows)(words)
    for word, logs in zip(words, got):
        for k in range(3):
            assert abs(logs[k] - math.log(plain_likelihood(word, pieces, p[:, k]))) < 1e-9
    longest = "ab" * (li.Forward.LETTERS // 2)
    assert np.allclose(li.Forward(table, rows)([longest]), li.word_log_likelihood(longest, table, [tuple(r) for r in rows.tolist()], 3))


def test_expected_counts_of_short_and_long_words():
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab"]
    p = np.array([0.1, 0.2, 0.3, 0.15, 0.05, 0.2])
    table, want = li.piece_table(pieces), Counter()
    for parts in pieces_of("▁abab"):
        if all(part in pieces for part in parts):
            for part in parts:
                want[part] += math.prod(p[pieces.index(x)] for x in parts) / plain_likelihood("abab", pieces, p)
    got = li.expected_counts(Counter({"abab": 2}), table, p)
    assert np.allclose(got, [2 * want[x] for x in pieces])
    # every letter of a long word is in one piece of each segmentation
    long = li.expected_counts(Counter({"ab" * 3000: 1}), table, p)
    assert np.isfinite(long).all() and abs(long @ [len(x) for x in pieces] - 6001) < 1e-3
    found = li.spans("▁" + "ab" * 5, table)
    assert abs(sum((j - i) * s for (i, j, _), s in zip(found, li._log_shares(11, found, [*p, li.UNKNOWN]))) - 11) < 1e-9


def test_texts_that_wait_and_repeated_words_score_alike(spark, monkeypatch):
    table = spark.createDataFrame([(i, f"the cat {i * 'sat '}on a mat" if i % 2 else f"die katze {i * 'auf '}matte", "en" if i % 2 else "de")
                                   for i in range(40)], "doc_id long, text string, lang string")
    model = li.fit(table)
    want = sorted(li.predicted(table, model).collect())
    for name, size in (("_CACHE_ROWS", 12), ("_WAIT", 9), ("_PART", 3), ("_BLOCK", 2)):
        monkeypatch.setattr(li, name, size)
    step = li._predictor(model)()
    batch = {"doc_id": [i for i, *_ in want], "text": [r.text for r in sorted(table.collect())]}
    out = [x for b in [*step[0](batch), *step[1]()] for x in zip(b["doc_id"], b["lang_pred"], b["score"])]
    assert [(i, l) for i, l, _ in out] == [(i, l) for i, l, _ in want]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(out, want))
