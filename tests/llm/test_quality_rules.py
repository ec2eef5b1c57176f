import re
from collections import Counter

import numpy as np

from martloom.llm import quality_rules as qr
from martloom.llm.words import WordHashes
from tests.conftest import DATA
from tests.llm.helpers import docs, sample

SPACE = "[\x20\x09-\x0d]+"


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    lines = [x for x in text.split("\n") if re.sub(SPACE, "", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    inside = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(inside), failed)


def counted(texts):
    held = qr.Texts(texts, WordHashes()).counts()
    return list(zip(*[held[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]))


def test_query(spark):
    found = qr.op12_quality_rules(spark, DATA)
    rows = {r.doc_id: r for r in found.collect()}
    texts = sample(spark, DATA, 1 << 40)
    assert len(rows) == len(texts)
    for i, text in texts:
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(text)
        assert 0 <= r.score <= 1 and r.kept == (not r.base_failed and r.score >= qr.THRESHOLD)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    unseen = {r[0] for r in spark.createDataFrame([(i,) for i in labels], "doc_id long").where(
        qr.fold(qr.F.col("doc_id"), 3) == 1).collect()}
    judged = [(rows[i].score >= qr.THRESHOLD) == bool(labels[i]) for i in unseen if i in rows and not rows[i].base_failed]
    assert len(judged) > 50 and np.mean(judged) >= 0.95


def test_counts_of_odd_texts():
    line = "one two three four five six seven eight"
    texts = [None, "", " \t\r\n", f"{line}\n{line}\n{line} nine", f"{line} {line}", "a\n \na\na \n\na", "ß # **  x\u0085y <é>",
             "w " * 40, "\x0b#\x0c", "😀 $ %&|"]
    assert counted(texts) == [plain_counts(t)[:5] for t in texts]


def test_score_is_the_plain_sum():
    """The batch score equals a loop over words, word pairs and character n-grams in plain Python."""
    weights = np.random.default_rng(1).standard_normal(2 * qr.BUCKETS)
    texts = ["Ein Satz, über alles.", "", "ab", "x y", "much longer text with ten words or so in it, truly"]

    def bucket(h):
        return int(qr.mixed(np.array([h % 2**64], np.uint64))[0] >> np.uint64(40)) % qr.BUCKETS

    cache, place = WordHashes(), [int(p) for p in qr._PLACE]
    for text, got in zip(texts, qr.Texts(texts, WordHashes()).means(weights)):
        h = [cache[w.encode()] for w in text.split()]
        words = [bucket(x) for x in h] + [bucket(a * place[0] + b * place[1]) for a, b in zip(h, h[1:])]
        chars = []
        for size in qr.CHAR_SIZES:
            for i in range(len(text) - size + 1):
                t = size
                for c in text[i:i + size]:
                    t = (t * 0x9E3779B1 + ord(c)) % 2**32
                t ^= t >> 15
                chars.append((t * 0x85EBCA77 % 2**32 >> 16) % qr.BUCKETS + qr.BUCKETS)
        mean = lambda b: weights[b].mean() if b else 0.0
        assert abs(got - mean(words) - mean(chars)) < 1e-9
        assert abs((qr.Texts([text], cache).shares() @ weights)[0] - got) < 1e-4


def test_calibration_recovers_the_line():
    rng = np.random.default_rng(2)
    logits = rng.standard_normal(20_000) * 3
    labels = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * logits - 1)))).astype(int)
    slope, shift = qr.calibrated(logits, labels)
    assert abs(slope - 0.5) < 0.03 and abs(shift + 1) < 0.08
    slope, shift = qr.calibrated(np.array([-1.0, 1.0]), np.array([0, 1]))
    assert np.isfinite([slope, shift]).all()


def test_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(30))
    long = " ".join(f"w{i % 50_000}" for i in range(200_000))
    table = docs(spark, [(1, good), (1, "other"), (2, None), (None, good), (3, ""), (4, long)], "score").selectExpr("*", "1 as kept")
    got = {(r.doc_id, r.n_words): (r.base_failed, r.kept) for r in qr.judged(table, 0.5).collect()}
    assert got == {(1, 30): (False, True), (1, 1): (True, False), (2, 0): (True, False), (None, 30): (False, True),
                   (3, 0): (True, False), (4, 200_000): (True, False)}
    assert qr.judged(docs(spark, []), 0.5).count() == 0
    labels = lambda *rows: spark.createDataFrame(rows, "doc_id long, label int")
    assert qr.fit(table, labels()) == qr.THRESHOLD
    assert qr.fit(table, labels((1, 1), (3, 1), (99, 0), (None, 0), (4, None))) == 1.0
    assert isinstance(qr.fit(table, labels((1, 1), (2, 0), (2, 0), (4, 0), (4, 1))), dict)
