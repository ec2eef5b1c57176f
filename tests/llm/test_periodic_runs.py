import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import periodic_runs as pr
from tests.conftest import DATA
from tests.llm.helpers import docs, sample


def plain_runs(words):
    """All (start, length, period), by trying every period."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_plain_version(spark):
    found = pr.op11_periodic_runs(spark, DATA)
    assert found.columns == COLUMNS
    got = {r.doc_id: tuple(r) for r in found.collect()}
    texts = sample(spark, DATA, 1 << 40)
    assert len(got) == len(texts)
    checked = with_runs = 0
    for i, text in texts:
        if len(text or "") < 12_000:  # the plain version is quadratic
            assert got[i] == plain_row(i, text)
            checked, with_runs = checked + 1, with_runs + (got[i][1] > 0)
    assert checked > 900 and with_runs > 50


periodic = st.builds(lambda u, k, cut, tail: (u * k)[:len(u) * k - cut] + tail,
                     st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 3),
                     st.lists(st.sampled_from("abcd"), max_size=6))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.builds(lambda *parts: [w for p in parts for w in p], periodic, periodic, periodic), max_size=4))
def test_runs_equal_plain_ones(texts):
    texts = [[w.encode() for w in t] for t in texts]
    assert pr.runs_of(texts) == [plain_runs(t) for t in texts]


def test_long_periods_and_many_rounds():
    unit = [str(i) for i in range(700)]
    text = ["x"] + unit * 5 + unit[:123] + ["y"] + ["a", "b"] * 8
    (runs,) = pr.runs_of([[w.encode() for w in text]])
    assert runs == plain_runs(text) == [(1, 3623, 700), (3625, 16, 2)]
    # every split makes another word rare
    nested = []
    for i in range(30):
        nested = [*nested, f"w{i}", *nested] if i < 8 else nested + [f"w{i}"] * 3
    (runs,) = pr.runs_of([[w.encode() for w in nested]])
    assert runs == plain_runs(nested)


def test_odd_rows(spark):
    long = "ab " * 300_000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a a a a a"), (5, "a a a a a a"), (5, "x y"), (None, "b " * 6), (6, long)]
    table = docs(spark, rows, "runs").selectExpr("*", "1 as starts", "2 as collapsed")
    got = sorted((r.doc_id or -1, r.n_words, r.starts, r.lengths, r.periods, r.strongest, bytes(r.collapsed)[:9])
                 for r in pr.periodic_runs(table).collect())
    one = lambda n: ([0], [n], [1], 0)
    none = ([], [], [], None)
    assert got == [(-1, 6, *one(6), b"b"), (1, 0, *none, b""), (2, 0, *none, b""), (3, 0, *none, b""),
                   (4, 5, *none, b"a a a a a"), (5, 2, *none, b"x y"), (5, 6, *one(6), b"a"), (6, 300_000, *one(300_000), b"ab")]
    assert pr.periodic_runs(docs(spark, [])).count() == 0
    assert pr.with_repeats(docs(spark, rows)).count() == len(rows)
