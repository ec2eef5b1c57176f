"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors are one class from the start. ``centroids`` fits cells on a bounded sample; every class vector then
has the cell of its nearest centroid as home and also visits each later cell whose boundary is so near that a
vector with the wanted cosine could lie beyond it: for unit centroids a (home) and b, if
``x . (a - b) <= sqrt(1 - cosine**2) * |a - b|``. So no link is lost, whatever the centroids, and each pair meets
exactly once: in the home of the later one. The price is that vectors without cluster structure visit many
cells. Within a cell, blocks of at most about ``BLOCK`` rows are multiplied pair by pair in tasks of their own, so a
cell with a third of all rows is spread; a task returns numbers of links and each row's least connected one, never pairs.

Rows: vectors that are null, empty, zero, or hold a null or non-finite component link with nothing. Vectors of
different lengths link with nothing of another length. A null ``vec_id`` gets a null component and is kept, without
links. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import components, map_columns, read, store

#: Vectors per cell that the number of cells aims at, the most cells, and the bound of the sample they are fitted on.
CELL_ROWS, MAX_CELLS, SAMPLE_ROWS = 4096, 512, 16_384
BLOCK = 2048
_SLACK, _PAIRS = 1e-5, 100_000
ITERATIONS = 6
PLACED = pa.schema([("cell", pa.int64()), ("home", pa.bool_()), ("id", pa.int64()), ("copies", pa.int64()),
                    ("vec", pa.list_(pa.float32()))])
LINKS = "id long, to long, links long"


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vec) of the vectors that can have links."""
    rows = embeddings.where("vec_id is not null and size(embedding) > 0").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>").alias("vec"))
    broken = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~broken).where(F.exists("vec", lambda x: x != 0))


def _unit(rows) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no square under- or overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _fit_cells(n: int):
    def fit(key: tuple, sample: pa.Table) -> pa.Table:
        x = _unit(sample.sort_by("id")["vec"].to_pylist())
        k = min(MAX_CELLS, len(x), max(1, math.ceil(n / CELL_ROWS)))
        centers = x[np.random.default_rng(5).choice(len(x), k, replace=False)]
        for _ in range(ITERATIONS):
            nearest = (x @ centers.T).argmax(axis=1)
            sums = np.zeros_like(centers)
            np.add.at(sums, nearest, x)
            norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            centers = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centers)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "centers": pa.array([centers.tobytes()], pa.binary())})

    return fit


def centroids(classes: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS) -> dict[int, np.ndarray]:
    """Unit centroids per vector length, from the ``sample_rows`` classes with the least hash of their id."""
    chosen = classes.orderBy(F.xxhash64("id"), "id").limit(sample_rows).withColumn("dim", F.size("vec"))
    fitted = chosen.groupBy("dim").applyInArrow(_fit_cells(n), "dim int, centers binary").collect()
    return {r.dim: np.frombuffer(r.centers).reshape(-1, r.dim) for r in fitted}


def _placer(cells: dict[int, np.ndarray], cosine: float):
    reach = math.sqrt(1 - cosine**2) + 1e-9
    gaps = {d: np.sqrt(np.maximum(0, 2 - 2 * c @ c.T)) * reach for d, c in cells.items()}
    # centroids that coincide separate nothing: their rows always meet

    def start():
        def place(batch: dict):
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(batch["vec"]):
                by_dim.setdefault(len(v), []).append(i)
            for dim, rows in by_dim.items():
                centers = cells.get(dim)
                plain = np.array([batch["vec"][i] for i in rows], np.float32)
                x = _unit(plain)
                if centers is None:  # a length that the sample missed is one cell
                    at, to = np.arange(len(rows)), np.zeros(len(rows), np.int64)
                    homes = to
                else:
                    near = x @ centers.T
                    homes = near.argmax(axis=1)
                    margin = near[np.arange(len(rows)), homes][:, None] - near
                    visits = (margin <= gaps[dim][homes]) & (np.arange(len(centers))[None, :] >= homes[:, None])
                    at, to = np.nonzero(visits)
                yield {"cell": (dim * (MAX_CELLS + 1) + to).tolist(), "home": (to == homes[at]).tolist(),
                       "id": [batch["id"][rows[i]] for i in at], "copies": [batch["copies"][rows[i]] for i in at],
                       "vec": list(plain[at])}

        return place

    return start


def _compare(cosine: float):
    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        left = rows["side"].to_numpy() == 0
        ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
        x = _unit(rows["vec"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1))
        own = len({*key[2:]}) == 1 and key[1].as_py() == "home"
        a, b = (np.flatnonzero(left),) * 2 if own else (np.flatnonzero(left), np.flatnonzero(~left))
        # single precision finds what may reach the limit, double precision decides
        i, j = np.nonzero(x[a].astype(np.float32) @ x[b].astype(np.float32).T >= cosine - _SLACK)
        i, j = a[i], b[j]
        if own:
            i, j = i[i < j], j[i < j]
        linked = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + _PAIRS]], x[j[k:k + _PAIRS]]) >= cosine
                                 for k in range(0, len(i), _PAIRS)] or [np.zeros(0, bool)])
        i, j = i[linked], j[linked]
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        least = np.arange(len(ids))  # each row's least connected row, found by halving paths
        while True:
            low = np.minimum(least[i], least[j])
            before = least.copy()
            np.minimum.at(least, i, low)
            np.minimum.at(least, j, low)
            least = least[least]
            if (least == before).all():
                break
        some, joined = np.flatnonzero(links), np.flatnonzero(least != np.arange(len(ids)))
        return pa.table({"id": np.r_[ids[some], ids[joined]],
                         "to": pa.array([None] * len(some) + ids[least[joined]].tolist(), pa.int64()),
                         "links": np.r_[links[some].astype(np.int64), np.zeros(len(joined), np.int64)]})

    return compare


def _pair_blocks(placed: DataFrame) -> DataFrame:
    """``placed`` rows once per pair of blocks they take part in: cell, kind, i, j, side."""
    sizes = placed.groupBy("cell").agg(*[F.ceil(F.count_if(c) / BLOCK).cast("int").alias(n) for n, c in (
        ("homes", F.col("home")), ("visits", ~F.col("home")))])  # a row per cell: MAX_CELLS per length
    rows = placed.join(F.broadcast(sizes), "cell")
    block = F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits"))).cast("int")
    rows = rows.withColumn("block", block)
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    homes = rows.where("home")
    within = homes.withColumn("other", F.explode(upto("homes"))).select(
        "cell", F.lit("home").alias("kind"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "copies", "vec")
    hosts = homes.where("visits > 0").withColumn("other", F.explode(upto("visits"))).select(
        "cell", F.lit("visit").alias("kind"), F.col("other").alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"),
        "id", "copies", "vec")
    guests = rows.where("not home and homes > 0").withColumn("other", F.explode(upto("homes"))).select(
        "cell", F.lit("visit").alias("kind"), F.col("block").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"),
        "id", "copies", "vec")
    return within.union(hosts).union(guests)


def near_vectors(embeddings: DataFrame, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row: links are cosines of ``cosine`` or more in double precision."""
    keys = [F.xxhash64("vec").alias("k1"), F.xxhash64("vec", F.lit(1)).alias("k2")]
    classes = store(valid_vectors(embeddings).select("vec_id", *keys, "vec").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vec").alias("vec")), "vectors")
    n = classes.count()
    cells = centroids(classes, n) if n else {}
    placed = store(map_columns(classes.select("id", "copies", "vec"), _placer(cells, cosine), PLACED), "placed")
    found = store(_pair_blocks(placed).groupBy("cell", "kind", "i", "j").applyInArrow(_compare(cosine), LINKS), "links")
    named = components(found.where("to is not null").select(F.col("id").alias("a"), F.col("to").alias("b")), "vectors")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    per_class = classes.select("k1", "k2", "id", "copies").join(counts, "id", "left").join(named, "id", "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "id").alias("component"))
    linked = valid_vectors(embeddings).select("vec_id", *keys).join(per_class, ["k1", "k2"])
    linked = linked.select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    rest = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>").alias("embedding"))
    unusable = F.coalesce(F.size("embedding") < 1, F.lit(True)) | F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists("embedding", lambda x: x != 0)
    rest = rest.where(F.col("vec_id").isNull() | F.coalesce(unusable, F.lit(True)))
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all ``embeddings`` at a cosine of 0.9."""
    return near_vectors(read(spark, sf_dir, "embeddings"), 0.9)


ORACLE_SQL = """
with recursive usable as (
    select vec_id, embedding::double[] as v, sqrt(list_inner_product(embedding::double[], embedding::double[])) as length
    from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
    select x.vec_id as a, y.vec_id as b
    from usable as x join usable as y on x.vec_id < y.vec_id and len(x.v) = len(y.v)
    where list_inner_product(x.v, y.v) / (x.length * y.length) >= 0.9),
neighbours as (select a as id, b as other from links union all select b, a from links),
reach as (
    select a as id, a as other from links union select b, b from links
    union select r.id, n.other from reach as r join neighbours as n on n.id = r.other),
components as (select id, min(other) as component from reach group by id),
counts as (select id, count(*) as n from neighbours group by id)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(component, vec_id) as component_id,
    coalesce(component, vec_id) = vec_id as kept
from embeddings left join components on components.id = vec_id left join counts on counts.id = vec_id
"""
