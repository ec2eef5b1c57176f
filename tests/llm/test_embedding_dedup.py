import numpy as np

from martloom.llm import embedding_dedup as ed
from tests.conftest import DATA
from tests.llm.helpers import smallest_reachable

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, cosine=0.9):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            usable[i] = x / np.sqrt(x @ x)
    links = [(a, b) for a in usable for b in usable if a < b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= cosine]
    component = smallest_reachable([i for i, _ in rows if i is not None], links)
    return {i: (sum(i in p for p in links), component[i]) for i, _ in rows if i is not None}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect() if r.vec_id is not None}


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert found(ed.op4_embedding_near_dedup(spark, DATA)) == brute(rows)


def test_many_cells_and_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ed, "CELL_ROWS", 40)
    monkeypatch.setattr(ed, "BLOCK", 16)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 8))
    rows = [(int(k), (base[k % 60] + 0.25 * rng.standard_normal(8)).astype(np.float32).tolist()) for k in rng.permutation(400)]
    rows += [(500 + k, rows[0][1]) for k in range(30)]
    want = brute(rows)
    assert found(ed.near_vectors(table(spark, rows))) == want
    assert len({c for _, c in want.values()}) < 300


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]),
            (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-30, 0.0]), (11, [3e38, 3e38]), (12, [1.0, 0.0])]
    out = ed.near_vectors(table(spark, [*rows, (None, [1.0, 0.0])])).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out if r.vec_id} == brute(rows)
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, True)]
    assert ed.near_vectors(table(spark, [])).count() == 0
