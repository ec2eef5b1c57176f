import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import line_dedup as ld
from martloom.llm import near_dedup as nd
from martloom.llm.common import LEAST, MARGIN, close
from martloom.llm.words import WordHashes, shingles
from tests.conftest import DATA
from tests.llm.helpers import docs, sample, similar_pairs, smallest_reachable, word_shingles


def brute(rows, percent):
    sets = {i: word_shingles(t) for i, t in rows}
    return {i: (len(sets[i]), c) for i, c in smallest_reachable(sets, similar_pairs(sets, percent)).items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_brute_force_on_documents(spark, percent):
    rows = sample(spark, DATA, 1000)
    got = found(nd.near_duplicates(docs(spark, rows), percent))
    assert got == brute(rows, percent)


def test_chain_of_near_copies(spark):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(40):  # each differs from the next in a few words, far ones in most
        rows.append((100 - k, " ".join(f"v{i}" if i < 4 * k else w for i, w in enumerate(words))))
    rows += [(200 + k, f"other text {k} with its own words {k * 7} and {k * 11}") for k in range(20)]
    got = found(nd.near_duplicates(docs(spark, rows), 85))
    assert got == brute(rows, 85)
    assert len({c for i, (_, c) in got.items() if i <= 100}) == 1


def test_nulls_short_texts_ties_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "É é"),
            (8, "é é"), (9, "a b c d e f"), (9, "a b c d e f"), (None, "one two"), (10, "one two"), (3, "one two")]
    df = docs(spark, rows, extra="component_id")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in nd.near_duplicates(df, 85).collect()), key=repr)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (3, 1, 3, True), (4, 1, 3, False), (5, 1, 3, False),
            (6, 1, 6, True), (7, 1, 7, True), (8, 1, 8, True), (9, 2, 9, True), (9, 2, 9, True),
            (10, 1, 3, False), (None, 1, None, True)]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert nd.near_duplicates(docs(spark, [])).count() == 0


def test_very_long_text(spark):
    text = " ".join(f"w{i % 9973}x{i}" for i in range(60_000))
    got = found(nd.near_duplicates(docs(spark, [(1, text), (2, text + " end"), (3, "short one")]), 85))
    assert got == {1: (59_996, 1), 2: (59_997, 1), 3: (1, 3)}


def test_registers_merge_and_estimate():
    cache = WordHashes()
    left = shingles(" ".join(f"a{i}" for i in range(900)).encode(), cache)
    right = shingles(" ".join(f"a{i}" for i in range(450, 1350)).encode(), cache)
    both = nd.registers(np.union1d(left, right))
    assert (nd.merged(nd.registers(left), nd.registers(right)) == both).all()
    one = lambda x: np.array([x])
    estimate = nd.likeliest(one(nd.registers(left)), one(nd.registers(right)), one(len(left)), one(len(right)))[0]
    assert abs(estimate - len(np.intersect1d(left, right)) / len(np.union1d(left, right))) < 0.12


def test_least_hashes_keep_similar_pairs(spark):
    """Pairs at the threshold or above pass whether their sets are held whole or not; unlike ones go."""
    rows, want = [], {}
    for i, (n, shared) in enumerate([(8, 8), (40, 38), (400, 368), (540, 497), (2000, 1840), (20000, 18400),
                                     (400, 250), (540, 338), (2000, 1250), (20000, 12500)]):
        words = [f"t{i}x{k}" for k in range(n)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:shared] + [f"u{i}x{k}" for k in range(n - shared)]))]
        a, b = word_shingles(rows[-2][1]), word_shingles(rows[-1][1])
        want[2 * i] = 100 * len(a & b) >= 85 * len(a | b)
    assert sorted(want.values()) == [False] * 4 + [True] * 6
    kept = nd.least_hashes(docs(spark, rows))
    pairs = kept.where("id % 2 = 0").selectExpr("id", "id + 1 as other", "least as x").join(
        kept.selectExpr("id as other", "least as y"), "other")
    assert max(len(r.least) for r in kept.collect()) == LEAST
    assert {r.id: r.close for r in pairs.select("id", close("x", "y", 85).alias("close")).collect()} == want


def test_close_is_a_test_of_whole_arrays(spark):
    """Full samples are compared as by the definition, without a function called for every hash."""
    rng, rows = random.Random(7), []
    for share in (0.0, 0.5, 0.7, 0.78, 0.8, 0.82, 0.9, 1.0):
        for size in (300, 511, 512, 900, 2500):
            every = [rng.randrange(-(1 << 31), 1 << 31) for _ in range(size)]
            sets = ({h for h in every if rng.random() < (1 + share) / 2} for _ in "ab")
            rows.append([sorted(s)[:LEAST] for s in sets])
    least = LEAST

    def want(x, y):
        both = len({*x} & {*y})
        if len(x) < least and len(y) < least:
            return 180 * both >= 80 * (len(x) + len(y)) - 100
        end = min(s[-1] for s in (x, y) if len(s) == least)
        held = sum(v <= end for v in (*x, *y))
        return 1.8 * both >= 0.8 * held - MARGIN * (0.8 * 0.2 / 1.8 * held) ** 0.5

    pairs = spark.createDataFrame(rows, "x array<int>, y array<int>")
    test = close("x", "y", 80)
    got = [r.ok for r in pairs.select(test.alias("ok")).collect()]
    assert got == [want(x, y) for x, y in rows] and {*got} == {True, False}
    assert "lambda" not in pairs.select(test)._jdf.queryExecution().optimizedPlan().toString()


def test_pair_tests_stay_short(spark):
    """The generated code of a join with a pair test has no method of over 8000 bytes, which the JVM would interpret."""
    table = spark.range(9).selectExpr("id", "id % 2 as k", "1 as n", "id as s0", "id as s1", "id as s2",
                                      "sequence(0L, 31L) as low", "sequence(0, 9) as least")
    x, y = (table.select(F.col("k").alias(f"{s}key"), *[F.col(c).alias(f"{s}{c}") for c in table.columns]) for s in ("x_", "y_"))
    for test in (ld._likely("x_", "y_"), nd._equal_bytes("x_low", "y_low") >= 100):
        joined = x.join(y.hint("merge"), F.col("x_key") == F.col("y_key")).where(
            test & close("x_least", "y_least", 85)).groupBy("x_id", "y_id").count()
        adaptive = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            said = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said)]
        assert sizes and max(sizes) < 8000
