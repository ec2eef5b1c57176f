"""Mixing sources to target weights by soft membership, in DataFrame operations only.

1. ``classifier``: multinomial naive Bayes over the ``VOCABULARY`` words that most labelled documents use,
   from a bounded sample of a labelled table.
2. ``posteriors``: every document's probability of each domain, tempered to ``EVIDENCE`` words so that long
   documents stay soft, and its number of words.
3. ``rates``: nonnegative rates per document whose expected domain totals (words * probability * rate)
   match the targets: distributed projected gradient. A step is one aggregate, the domain totals and the Gram matrix of the
   posteriors; every document's rate then moves by its posterior times the preconditioned gap of the totals and is projected onto
   the allowed rates. The Gram matrix makes rare domains arrive as fast as frequent ones. Rates of what is in proportion stay 1.
4. ``mixed``: documents repeated or left out by their rates.

A domain is any label of a document; there may be some dozens. The word model joins as a table of at most
``VOCABULARY`` rows; all that reaches the driver are sums per domain.

Rows: without words (null or empty text) a document has the prior's probabilities and no weight in the totals.
Rows sharing a ``doc_id`` (or having none) are one document: their words count together, each gets the rate.
Without labelled documents there is one nameless domain. Only ``doc_id`` and ``text`` of the documents are read.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import fresh, marked, passing, read, store

VOCABULARY = 4000
#: Bound of the labelled sample that the classifier is fitted on.
SAMPLE_ROWS = 5000
EVIDENCE = 16.0
#: Targets are the domains' present shares to this power, so that rare domains gain.
TEMPERATURE = 0.7
#: Deviation from a domain's own target at which gradient steps end, and that above which a warning is given.
TOLERANCE, REACHED = 1e-4, 0.02
#: Steps without getting a tenth nearer after which they end; steps that are one expression before rates are stored.
PATIENCE, FOLD = 8, 6
#: Keeps the Gram matrix regular where two domains never differ.
RIDGE = 1e-8


def _words(docs: DataFrame) -> DataFrame:
    """(doc_id, ..., word): lower-cased runs without white space."""
    others = [c for c in docs.columns if c != "text"]
    parts = F.explode(F.split(F.lower("text"), r"\s+"))
    return docs.select(*others, parts.alias("word")).where("word <> ''")


def classifier(docs: DataFrame, labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], list[float], DataFrame]:
    """Domains, log priors, and (word, weights): log likelihoods per domain.

    ``labelled``: (doc_id, domain). Of the labelled documents those with the least hash of their id are used.
    """
    labelled = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(
        F.min(F.col("domain").cast("string")).alias("domain"))
    chosen = store(labelled.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "labelled")
    shares = {r.domain: r["count"] for r in chosen.groupBy("domain").count().collect()}
    domains = sorted(shares) or [""]
    prior = [math.log((shares.get(d, 0) + 1) / (sum(shares.values()) + len(domains))) for d in domains]
    words = _words(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    counts = words.groupBy("word").agg(
        F.count_distinct("doc_id").alias("docs"), *[F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains)])
    top = store(counts.orderBy(F.desc("docs"), "word").limit(VOCABULARY), "vocabulary")
    totals = top.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(len(domains))]).first()
    weights = F.array(*[F.log((F.col(f"n{k}") + 1) / F.lit(float(totals[k] + VOCABULARY))) for k in range(len(domains))])
    return domains, prior, store(top.select("word", weights.alias("weights")), "word-weights")


def posteriors(docs: DataFrame, model: tuple[list[str], list[float], DataFrame]) -> DataFrame:
    """(doc_id, tokens, posterior): words of each document and its domain probabilities, in the order of the domains."""
    _, prior, weights = model
    domains = range(len(prior))
    hits = _words(docs.select("doc_id", "text")).join(F.broadcast(weights), "word", "left")
    sums = hits.groupBy("doc_id").agg(
        F.count("*").alias("tokens"), F.count("weights").alias("known"),
        *[F.coalesce(F.sum(F.get("weights", F.lit(k))), F.lit(0.0)).alias(f"s{k}") for k in domains])
    ids = docs.select("doc_id").distinct().withColumnRenamed("doc_id", "_id")
    sums = ids.join(sums, F.col("_id").eqNullSafe(F.col("doc_id")), "left").select(
        F.col("_id").alias("doc_id"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        *[(F.coalesce(F.col(f"s{k}") * F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(F.col("known"), F.lit(1))), F.lit(0.0)) + prior[k]).alias(f"s{k}")
          for k in domains])
    top = F.greatest(*[F.col(f"s{k}") for k in domains]) if len(prior) > 1 else F.col("s0")
    odds = sums.select("doc_id", "tokens", *[F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in domains])
    total = sum((F.col(f"e{k}") for k in domains), F.lit(0.0))
    return odds.select("doc_id", "tokens", F.array(*[F.col(f"e{k}") / total for k in domains]).alias("posterior"))


def _dot(factors: Sequence[float]) -> Column:
    return sum((F.get("posterior", F.lit(k)) * F.lit(float(c)) for k, c in enumerate(factors)), F.lit(0.0))


def rates(soft: DataFrame, targets: Sequence[float] | None = None, least_rate: float = 0.0,
          total: float | None = None) -> DataFrame:
    """``soft`` (doc_id, tokens, posterior) plus ``rate``.

    ``targets``: relative weight per domain (default: present shares to the power ``TEMPERATURE``); ``total``: words
    wanted in all, as a multiple of those present (default 1, or with a ``least_rate`` as many as leave no
    domain below it). Projected gradient steps from rates of 1 towards the least squared distance of the domain totals from
    their targets over rates >= ``least_rate`` (0 or more). Distances count in the metric of the Gram matrix, in which domains
    are independent. Ends when every domain is within ``TOLERANCE`` of its own target or ``PATIENCE`` steps came no nearer, with the
    nearest rates; a warning names totals that are not within ``REACHED`` of their targets.
    """
    n = len(soft.select("posterior").first()[0]) if not soft.isEmpty() else 1
    share = [F.col("tokens") * F.get("posterior", F.lit(k)) for k in range(n)]
    row = soft.agg(F.sum("tokens"), *[F.sum(s) for s in share]).first()
    words = float(row[0] or 0)
    start = F.lit(max(1.0, float(least_rate)))
    if not words:
        return soft.withColumn("rate", start)
    present = np.array(row[1:n + 1], float) / words
    want = np.array(targets, float) if targets is not None else present**TEMPERATURE
    want = want / want.sum()
    scale = total if total is not None else 1.0
    if total is None and least_rate:
        scale = max(1.0, float((least_rate * present / np.maximum(want, 1e-12)).max()))
    want = want * scale
    ridge = RIDGE * np.eye(n)

    def measured(rated: DataFrame, step: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Domain totals, the Gram matrix of all documents, and that of the documents which the last step could move."""
        loose = F.lit(True) if step is None else (F.col("rate") > least_rate) | (_dot(step) < 0)
        pairs = [share[i] * F.get("posterior", F.lit(j)) for i in range(n) for j in range(i, n)]
        sums = rated.withColumn("_loose", loose).agg(
            *[F.sum(s * F.col("rate")) for s in share], *[F.sum(x) for x in pairs],
            *[F.sum(F.when(F.col("_loose"), x).otherwise(0.0)) for x in pairs]).first()
        sums, half = np.array(sums, float) / words, len(pairs)
        grams = []
        for part in (sums[n:n + half], sums[n + half:]):
            m = np.zeros((n, n))
            m[np.triu_indices(n)] = part
            grams.append(m + np.triu(m, 1).T + ridge)
        return sums[:n], *grams

    base, steps, step = soft.withColumn("rate", start), [], None
    near, nearest, waited = TOLERANCE * np.maximum(want, 1e-9 * scale), None, 0
    with passing() as keep:
        while True:
            # some steps are one expression, then their rates are stored
            if len(steps) == FOLD:
                base, steps = store(_stepped(base, steps, least_rate), "rates"), []
            totals, gram, loose = measured(_stepped(base, steps, least_rate), step)
            gap = totals - want
            loss = float(gap @ np.linalg.solve(gram, gap))
            better = nearest is None or loss < nearest[0]
            waited = 0 if better and (nearest is None or loss < 0.9 * nearest[0]) else waited + 1
            if better:
                nearest = loss, base, list(steps), gap
            if (np.abs(gap) <= near).all() or waited > PATIENCE:
                break
            # a step that came no nearer is followed by one in the full metric, whose length is safe
            step = np.linalg.solve(loose if better else gram, gap)
            steps.append(step)
        _, base, steps, gap = nearest
        if (np.abs(gap) > REACHED * want).any():
            warnings.warn(f"rates: domain totals {(gap + want).tolist()} for targets {want.tolist()}", stacklevel=2)
        return keep(store(_stepped(base, steps, least_rate), "rated"))


def _stepped(rated: DataFrame, steps: Sequence[np.ndarray], least_rate: float) -> DataFrame:
    """Rates after gradient steps, each projected onto what is allowed."""
    rate = F.col("rate")
    for step in steps:
        rate = F.greatest(F.lit(float(least_rate)), rate - _dot(step))
    return rated.select("doc_id", "tokens", "posterior", rate.alias("rate"))


def mixed(docs: DataFrame, rated: DataFrame) -> DataFrame:
    """``docs`` with each row floor(rate + u) times, u uniform in [0, 1) from the id's hash."""
    u = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 32)) / float(1 << 32)
    flag, copies, copy = fresh(docs, "maybe", "copies", "copy")
    times = rated.select("doc_id", F.floor(F.col("rate") + u).cast("int").alias(copies))
    other = store(times.where(F.col(copies) != 1).distinct(), "copies")
    split = marked(docs, "doc_id", other.select("doc_id"), flag)
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = split.where(~F.col(flag)).select(*own)
    again = split.where(F.col(flag)).alias("d").join(other.alias("o"), F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")), "left")
    again = again.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.coalesce(copies, F.lit(1)).alias(copies))
    again = again.where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return once.union(again.select(*own))


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of the documents that the labels table covers."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


def domain_rates(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] | None = None,
                 least_rate: float = 0.0) -> tuple[list[str], DataFrame]:
    """Domains and (doc_id, tokens, posterior, rate) of all documents; a domain without a target gets 0."""
    model = classifier(docs, labelled_domains(docs, labels))
    soft = store(posteriors(docs, model), "posteriors")
    wanted = None if targets is None else [targets.get(d, 0.0) for d in model[0]]
    return model[0], rates(soft, wanted, least_rate)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of ``documents`` for the default targets over languages."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    domains, rated = domain_rates(docs, labels)
    best = F.array_position("posterior", F.array_max("posterior")).cast("int") - 1
    return rated.select("doc_id", "tokens", F.get(F.array(*map(F.lit, domains)), best).alias("domain"),
                        F.array_max("posterior").alias("probability"), "posterior", "rate")
