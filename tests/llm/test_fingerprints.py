import hashlib

from martloom.llm import fingerprints as fp
from martloom.llm.words import WordHashes
from tests.conftest import DATA
from tests.llm.helpers import docs, sample, word_shingles


def brute(rows):
    """doc_id -> (n_chars, sha256 of the edited text, true likeness to it, true likeness to the next)."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        sets = [word_shingles(x) for x in (t, edited, after)]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), like(sets[0], sets[1]), like(sets[0], sets[2]))
    return out


def check(rows, got, tolerance):
    want = brute(rows)
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        n, sha, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert abs(r.near_edited - edited) <= tolerance and abs(r.near_next - after) <= tolerance


def test_equals_brute_force_on_documents(spark):
    rows = sample(spark, DATA, 1000)
    got = fp.op5_document_fingerprints(spark, DATA).collect()
    check(rows, got, 0.16)
    prints = {}
    for r in got:
        prints.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    want = brute(rows)
    mean = sum(r.near_edited - want[r.doc_id][2] for r in got) / len(got)
    assert abs(mean) < 0.02  # the bias correction holds


def test_nulls_short_texts_and_ties(spark):
    rows = [(1, None), (2, ""), (3, "é"), (4, "one two three"), (5, "one two three"), (6, " \n"), (-7, "x y"), (1 << 60, "z")]
    got = fp.edited_fingerprints(docs(spark, rows, extra="fingerprint")).collect()
    check(rows, got, 0.0)
    by = {r.doc_id: r.fingerprint for r in got}
    assert by[1] == by[2] == by[6] == "" and by[4] == by[5] != by[3]
    twice = fp.edited_fingerprints(docs(spark, [(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert sorted((r.doc_id, r.n_chars) for r in twice if r.doc_id) == [(1, 3), (1, 3)] and len(twice) == 3


def test_empty_table_and_long_text(spark):
    assert fp.edited_fingerprints(docs(spark, [])).count() == 0
    long = " ".join(f"w{i}" for i in range(50_000))
    check([(1, long), (2, long[: len(long) // 2])], fp.edited_fingerprints(docs(spark, [(1, long), (2, long[: len(long) // 2])])).collect(), 0.16)


def test_two_shingles_fill_all_bins():
    print_ = fp.fingerprint("a b c d e f", WordHashes())
    assert len(print_) == fp.BINS * fp.BITS // 8 and fp.likeness(print_, print_) == 1.0
