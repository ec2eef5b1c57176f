import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martloom.llm import packing as pk
from tests.conftest import DATA
from tests.llm.helpers import docs, sample


def check_places(rows, capacity=1024):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query_equals_the_tokenizer(spark):
    rows = pk.op7_best_fit_packing(spark, DATA).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = 0
    for i, text in sample(spark, DATA, 1000):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        cuts = [0, *range(len(ids) % 1024 or min(1024, len(ids)), len(ids), 1024), len(ids)]
        want = [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
        assert sorted(got.pop(i)) == want
    assert not got
    assert check_places(rows) <= -(-total // 1024) + 4


def test_exchange_rounds_keep_all_pieces(spark):
    lengths = [int(x) for x in np.random.default_rng(2).integers(200, 520, 900)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    whole = pk.packed(pieces).collect()
    dealt = pk.packed(pieces, partition_pieces=90).collect()
    for rows in (whole, dealt):
        assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    apart = pk.packed(pieces, partition_pieces=90, rounds=0).collect()
    assert pk.lower_bound(np.array(lengths)) <= check_places(whole) <= check_places(dealt) <= check_places(apart)


def test_nulls_white_space_special_token_repeats(spark):
    rows = [(1, None), (2, ""), (3, "a  b \n\n c"), (4, "x<|endoftext|>y"), (5, "same"), (5, "same"), (None, "é")]
    out = pk.pack_documents(docs(spark, rows, extra="piece")).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
    assert check_places(out) == 1
    assert pk.pack_documents(docs(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_and_bound(lengths):
    x = np.array(lengths, np.int64)
    bins, offsets, room = pk.best_fit(x, 64)
    used = np.bincount(bins, weights=x, minlength=len(room)) if len(x) else np.zeros(0)
    assert (used + np.array(room) == 64).all()
    assert pk.lower_bound(x, 64) <= len(room)
    assert all(0 <= o and o + n <= 64 for o, n in zip(offsets, lengths))
