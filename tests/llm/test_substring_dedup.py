import hashlib
import random

import numpy as np
import pytest

from martloom.llm import substring_dedup as sd
from martloom.llm import suffix_array as sa
from tests.conftest import DATA
from tests.llm.helpers import docs, sample


def brute(rows):
    """doc_id -> (n_bytes, n_removed, n_spans, remaining bytes), every string of 100 bytes looked up."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = b"\1" * 100
            else:
                seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, kept)
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, bytes(r.kept)) for r in df.collect()}


def test_query_equals_brute_force(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.op1_suffix_array_dedup(spark, DATA).collect()}
    want = {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for i, w in brute(sample(spark, DATA, 1000)).items()}
    assert got == want


def test_overlaps_periods_edges_and_nulls(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared, other = word(180), word(130)
    rows = [(1, None), (2, ""), (3, word(99)), (4, "ab" * 200), (5, word(40) + shared + word(30)),
            (6, shared + word(10) + other), (7, other + shared[40:] + other), (8, "x" * 100), (9, "x" * 100), (10, "x" * 350),
            (11, word(20) + shared[:101]), (12, shared[5:160] + other[3:]), (13, "ab" * 200), (14, "x" * 99)]
    assert found(sd.without_repeats(docs(spark, rows, extra="kept"))) == brute(rows)


def test_many_versions_of_one_passage(spark):
    rng = random.Random(4)
    base = [rng.choice("abcdefghij") * 3 for _ in range(300)]
    rows = [(k, "".join(rng.choice("klm") if rng.random() < 0.01 else w for w in base)) for k in range(60)]
    assert found(sd.without_repeats(docs(spark, rows))) == brute(rows)


def test_repeated_rows_null_ids_empty_table(spark):
    text = "0123456789" * 30
    got = sorted(((r.doc_id, len(r.kept)) for r in sd.without_repeats(docs(spark, [(1, text), (1, text), (None, text), (None, text)])).collect()), key=repr)
    want = len(brute([(1, text)])[1][3])
    assert got == sorted([(1, want), (1, want), (None, 300), (None, 300)], key=repr)
    assert sd.without_repeats(docs(spark, [])).count() == 0


def test_different_texts_of_one_id_are_different_documents(spark):
    rng = random.Random(8)
    x, y, z = ("".join(rng.choice("abcdefg ") for _ in range(300)) for _ in range(3))
    rows = [(1, x), (5, x), (5, y), (5, y), (5, "short"), (5, None), (7, z + y[:150]), (-3, z[100:]), (None, y)]
    got = sorted((repr(r.doc_id), r.n_bytes, len(r.kept), r.n_spans) for r in sd.without_repeats(docs(spark, rows)).collect())
    assert got == sorted([("1", 300, 300, 0), ("5", 300, 0, 1), ("5", 300, 300, 0), ("5", 300, 300, 0), ("5", 5, 5, 0), ("5", 0, 0, 0),
                          ("7", 450, 100, 1), ("-3", 200, 200, 0), ("None", 300, 300, 0)])


@pytest.mark.parametrize("limit", [0, 4096])
def test_suffix_array_and_prefixes(monkeypatch, limit):
    monkeypatch.setattr(sa, "_BUCKETWISE", limit)
    rng = np.random.default_rng(limit)
    for _ in range(120):
        s = np.r_[rng.integers(1, rng.integers(2, 6), rng.integers(1, 80)), 0]
        plain, order = s.tolist(), sa.suffix_array(s)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: plain[i:])
        shared = sa.common_prefixes(s.astype(np.uint8), order, 20)
        for a, b in zip(order[1:], order[:-1]):
            n = next((k for k in range(20) if max(a, b) + k >= len(s) or s[a + k] != s[b + k]), 20)
            assert shared[a] == n
