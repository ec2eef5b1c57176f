from collections import Counter

import numpy as np

from martloom.llm import mixing as mx
from tests.conftest import DATA
from tests.llm.helpers import docs


def totals(rows):
    return sum(r.tokens * np.array(r.posterior) * r.rate for r in rows)


def test_query_reaches_its_targets(spark):
    rows = mx.op9_source_mixing(spark, DATA).collect()
    assert len(rows) == 1000 and all(r.rate >= 0 and abs(sum(r.posterior) - 1) < 1e-9 for r in rows)
    texts = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert all(r.tokens == len(texts[r.doc_id].text.split()) for r in rows)
    present = sum(r.tokens * np.array(r.posterior) for r in rows)
    want = (present / present.sum()) ** mx.TEMPERATURE
    assert np.abs(totals(rows) / present.sum() - want / want.sum()).max() < 1e-3
    assert sum(r.domain == texts[r.doc_id].lang for r in rows) > 950


def test_rates_equal_a_plain_solver(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.4, 0.4, 0.4], 80)
    t = rng.integers(1, 50, 80)
    soft = spark.createDataFrame([(i, int(n), x.tolist()) for i, (n, x) in enumerate(zip(t, p))], "doc_id long, tokens long, posterior array<double>")
    for targets, least in (([0.2, 0.3, 0.5], 0.0), ([0.1, 0.25, 0.65], 0.0), ([0.3, 0.3, 0.4], 1.0)):
        rows = mx.rates(soft, targets, least).collect()
        got = np.array([r.rate for r in sorted(rows, key=lambda r: r.doc_id)])
        assert got.min() >= least
        a, scale = (p * t[:, None]).T / t.sum(), 1.0
        if least:
            scale = max(1.0, (a.sum(axis=1) / np.array(targets)).max())
        r = np.ones(80) * max(1.0, least)
        for _ in range(20_000):  # projected gradient with a small step
            r = np.maximum(least, r - 0.5 * p @ (a @ r - np.array(targets) * scale))
        loss = lambda x: ((a @ x - np.array(targets) * scale) ** 2).sum()
        assert loss(got) <= loss(r) + 5e-5


def test_mixed_repeats_and_drops_by_rate(spark):
    table = docs(spark, [(i, f"text {i}") for i in range(400)] + [(None, "t")], extra="rate")
    rated = spark.createDataFrame([(i, [0.0, 1.0, 1.5, 3.0][i % 4]) for i in range(400)] + [(None, 2.0)], "doc_id long, rate double")
    out = mx.mixed(table, rated).collect()
    counts = Counter(r.doc_id for r in out)
    assert out[0].rate == "x" and counts[None] == 2
    assert all(counts[i] == [0, 1, counts[i], 3][i % 4] for i in range(400))
    assert 120 < sum(counts[i] for i in range(2, 400, 4)) < 180


def test_nulls_empty_table_no_labels(spark):
    labels = spark.createDataFrame([(1,), (2,)], "doc_id long")
    table = docs(spark, [(1, "a b"), (2, None), (3, ""), (None, "c d"), (4, "e f"), (4, "e f")])
    domains, rated = mx.domain_rates(table, labels)
    got = {r.doc_id: r.tokens for r in rated.collect()}
    assert domains == ["en"] and got == {1: 2, 2: 0, 3: 0, None: 2, 4: 4}
    assert mx.domain_rates(table, labels.limit(0))[0] == [""]
    domains, rated = mx.domain_rates(docs(spark, []), labels)
    assert rated.count() == 0 and mx.mixed(docs(spark, []), rated).count() == 0


def test_rare_domains_arrive(spark):
    for shares in ([0.6, 0.25, 0.1, 0.049, 0.001], [0.9, 0.05, 0.03, 0.01, 0.01]):
        n = len(shares)
        soft = [(i, int(100_000 * s), [0.96 if j == i else 0.01 for j in range(n)] if mix else [float(j == i) for j in range(n)])
                for mix in (0, 1) for i, s in enumerate(shares)]
        for least in (0.0, 1.0):
            rows = mx.rates(spark.createDataFrame(soft[:n] if least else soft, "doc_id long, tokens long, posterior array<double>"), least_rate=least).collect()
            present = sum(r.tokens * np.array(r.posterior) for r in rows)
            got, want = totals(rows), (present / present.sum()) ** mx.TEMPERATURE
            assert np.abs(got / got.sum() / (want / want.sum()) - 1).max() < 1e-3 and min(r.rate for r in rows) >= least - 1e-9


def test_gradient_steps_beat_a_plain_solver_in_the_metric_of_the_posteriors(spark):
    # soft documents, some of whose domains cannot be reached with rates of 1 or more
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.05] * 4, 300)
    t = rng.integers(1, 50, 300)
    soft = spark.createDataFrame([(i, int(n), x.tolist()) for i, (n, x) in enumerate(zip(t, p))], "doc_id long, tokens long, posterior array<double>")
    for least in (0.0, 1.0):
        got = np.array([r.rate for r in sorted(mx.rates(soft, [0.7, 0.1, 0.1, 0.1], least).collect(), key=lambda r: r.doc_id)])
        a, want = (p * t[:, None]).T / t.sum(), np.array([0.7, 0.1, 0.1, 0.1])
        want = want * (max(1.0, (a.sum(axis=1) / want).max()) if least else 1.0)
        metric = np.linalg.inv(p.T @ (p * (t / t.sum())[:, None]))
        r = np.full(300, max(1.0, least))
        for _ in range(5000):
            r = np.maximum(least, r - p @ (metric @ (a @ r - want)))
        loss = lambda x: (a @ x - want) @ metric @ (a @ x - want)
        assert got.min() >= least and loss(got) <= loss(r) + 1e-4
