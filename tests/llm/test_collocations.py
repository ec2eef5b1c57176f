import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import collocations as co
from martloom.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_counts(rows):
    """{(lang, words): occurrences} for 1 to 3 words."""
    found = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            for k in (1, 2, 3):
                found.update(("und" if lang is None else lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return found


def plain_collocations(rows, least, top):
    f = plain_counts(rows)
    n = Counter()
    for (lang, w), c in f.items():
        if len(w) == 1:
            n[lang] += c
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    dropped = {(lang, w[i:i + 2]) for (lang, w), a in candidates.items() if len(w) == 3 for i in (0, 1)
               if 100 * a >= 50 * candidates[(lang, w[i:i + 2])]}
    scored = []
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            s, _, left, right = min((1000000 * a * a // (f[(lang, w[:k])] * f[(lang, w[k:])]), k, f[(lang, w[:k])],
                                     f[(lang, w[k:])]) for k in range(1, len(w)))
            scored.append((lang, -s, -a, " ".join(w).encode(), left, right))
    out, rank = [], Counter()
    for lang, s, a, phrase, left, right in sorted(scored):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -s))
    return out


def test_oracle(spark, duck):
    """The registered SQL gives the same rows, types included."""
    for name, sql in ORACLES.items():
        want, got = duck.sql(sql), QUERIES[name](spark, DATA)
        columns = sorted(got.columns)
        assert sorted(want.columns) == columns
        types = dict(zip(want.columns, map(str, want.types)))
        assert {f.name: f.dataType.simpleString() for f in got.schema} == {
            c: {"BIGINT": "bigint", "VARCHAR": "string", "INTEGER": "int", "BOOLEAN": "boolean"}[t] for c, t in types.items()}
        found = sorted(tuple(r[c] for c in columns) for r in got.collect())
        assert found == sorted(tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall())
        assert len(found) > 500


def test_small_shards_ties_and_odd_rows(spark):
    rows = ([("en", "New York, new YORK. is\tin New York state\nstate of New York")] * 4
            + [(None, "a b a b a b a b a b a b"), ("", "a b\x0bc d"), ("de", None), ("de", "  . ,"), (None, "é É é É; é É")]
            + [("fr", "x y z. x y z! p q r; p q r: x y")] * 6 + [("es", "long " * 5000)])
    table = spark.createDataFrame([(i % 3 if i % 2 else None, lang, t, 1, 2) for i, (lang, t) in enumerate(rows)],
                                  "doc_id long, lang string, text string, a int, phrase int")
    for limit in (3, 50, 1 << 20):
        got = sorted(tuple(r) for r in co.collocations(table.repartition(3), 5, limit).collect())
        assert got == sorted(plain_collocations(rows, 10, 5))
    assert co.collocations(table.limit(0)).count() == 0
    assert co.collocations(table.where("text is null")).count() == 0


def test_phrase_extensions(spark):
    rows = [("en", "of the sea. the sea of the sea")] * 5
    table = spark.createDataFrame(rows, "lang string, text string")
    got = {r.phrase: (r["count"], r.left, r.right) for r in co.phrases(table).collect() if r.n_words}
    assert got == {"of": (10, 5, 10), "the": (15, 10, 15), "sea": (15, 15, 5), "of the": (10, 5, 10),
                   "the sea": (15, 10, 5), "of the sea": (10, 5, 0)}


def test_words_count_in_shards_without_their_phrases(spark):
    """A word's occurrences apart from its frequent phrases are counted, though other shards hold those."""
    rows = [("en", "new york")] * 12 + [("en", text) for i in range(30) for text in ("york", f"old york{i}", "new")]
    table = spark.createDataFrame(rows, "lang string, text string")
    for limit in (2, 1 << 20):
        got = [tuple(r) for r in co.collocations(table.repartition(3), 5, limit).collect()]
        assert got == plain_collocations(rows, 10, 5) == [("en", 1, "new york", 12, 42, 42, 144, 81632)]


def test_packed_sums():
    hashes = np.array([0, 0, 7, 2**20, 2**24 - 1], np.uint32)
    for n in (1, 3, 5):
        got = co.unpacked(co.packed(hashes[:n], np.arange(n, dtype=np.uint8)), n)
        assert got[0].tolist() == hashes[:n].tolist() and got[1].tolist() == list(range(n))
    # of two million hashes a bucket, spread over a hundred shards, one takes two bytes
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**24, 10_000)).astype(np.uint32)
    assert len(co.packed(hashes, np.ones(10_000, np.uint8))) < 2.1 * 10_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60))
def test_index_equals_plain_counts(body):
    ids = np.array([0, *body, 0], np.int64)
    index = co.FmIndex(ids)
    starts, interval = index.words()
    for size in (1, 2, 3):
        want = Counter(tuple(body[i:i + size]) for i in range(len(body) - size + 1) if 0 not in body[i:i + size])
        at = index.order[starts]
        said = [tuple(ids[p:p + size].tolist()) for p in at]
        assert len(set(said)) == len(said)
        assert dict(zip(said, index.count(interval, len(starts)).tolist())) == want
        # the step to the left: the rows of an interval whose word before is c lead to those of c with it
        starts, interval = index.extended(interval, np.ones(len(starts), bool))


def test_large_counts_stay_exact(spark):
    """Scores of counts whose products pass 64 bits."""
    a, left, right = 2**41 + 1, 2**44 + 7, 2**43 + 3
    got = spark.sql(f"select cast(cast(1000000 as decimal(38,0)) * cast({a}L as decimal(38,0)) * cast({a}L as decimal(38,0))"
                    f" div (cast({left}L as decimal(38,0)) * cast({right}L as decimal(38,0))) as long) as s").first().s
    assert got == 1000000 * a * a // (left * right)
