"""What the operators share: reading tables, cutting lineage, linking within buckets, components.

Nothing here collects rows. Intermediate tables go to the folder that ``spark.checkpoint.dir``
names, so a lost executor costs a re-run of a task, never of the whole lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import delete, scratch_path, tidy

_SQL_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean",
              pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>",
              pa.list_(pa.int32()): "array<int>", pa.list_(pa.float32()): "array<float>"}


_ROWS = 500
#: Smallest hashes of a set that ``close`` compares; most sets have no more.
LEAST = 512
#: Standard errors by which an estimate may lie below the threshold before a pair is dropped unseen.
MARGIN = 5.0
_BUCKET_ROWS = 200
#: Rounds in which the largest component of a bucket is searched for partners of the others, before these meet in pairs.
_ROUNDS = 3


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a lineage cut that outlives executors."""
    path = scratch_path(df.sparkSession, label)
    with tidy(df.sparkSession):
        df.write.parquet(path)
    if _PASSING:
        _PASSING[-1][path] = df.sparkSession
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


_PASSING: list[dict[str, SparkSession]] = []


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored inside are deleted at the end, all but those handed to the function it gives.

    For steps that end in a stored result: nothing reads what led to it any more.
    """
    _PASSING.append({})

    def keep(df: DataFrame) -> DataFrame:
        spark = _PASSING[-1].pop(df.stored_at, None)
        if spark is not None and len(_PASSING) > 1:
            _PASSING[-2][df.stored_at] = spark
        return df

    try:
        yield keep
    finally:
        for path, spark in _PASSING.pop().items():
            delete(spark, path)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each with as many underscores before it as make it differ from all columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def map_columns(df: DataFrame, start: Callable[[], Callable[[dict], Iterator[dict]]], out: pa.Schema) -> DataFrame:
    """``df`` through Python, batch by batch: ``start()`` runs once per task and gives a function
    from a batch's columns (lists, nulls as None, 64-bit values exact) to any number of batches, or a
    pair of that and a function for what comes after the last batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        step, last = step if isinstance(step, tuple) else (step, tuple)
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):  # few texts at a time are Python objects
                for columns in step(batch.slice(i, _ROWS).to_pydict()):
                    yield pa.RecordBatch.from_pydict(columns, schema=out)
        for columns in last():
            yield pa.RecordBatch.from_pydict(columns, schema=out)

    return df.mapInArrow(run, ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in out))


BITS = 23


def marked(df: DataFrame, column: str, wanted: DataFrame, flag: str = "maybe") -> DataFrame:
    """``df`` plus a boolean ``flag`` that is true wherever ``column`` is among the ids of ``wanted``.

    A one-hash Bloom filter as a table: 2**23 bits in at most 131,072 rows of 64, whatever the input,
    so the broadcast is bounded (some MB). It lets rows through by mistake, more of them the more ids
    there are, and never stops a wanted one; an exact join follows where that matters.
    """
    (name,) = wanted.columns
    spot, word, bits = fresh(df, "p", "word", "bits")
    place = lambda c: F.xxhash64(F.col(c)).bitwiseAND(F.lit((1 << BITS) - 1))
    words = wanted.select(place(name).alias(spot)).groupBy(F.shiftright(spot, 6).alias(word)).agg(
        F.expr(f"bit_or(shiftleft(1L, cast({spot} & 63 as int)))").alias(bits))
    spots = df.withColumn(spot, place(column)).withColumn(word, F.shiftright(spot, 6))
    seen = F.expr(f"(shiftright({bits}, cast({spot} & 63 as int)) & 1L) = 1L")
    return spots.join(F.broadcast(words), word, "left").withColumn(
        flag, F.coalesce(seen, F.lit(False))).drop(spot, word, bits)


def close(a: str, b: str, percent: int) -> Column:
    """Whether two columns of the ``LEAST`` smallest 32-bit hashes of sets, in order, allow the similarity.

    Two whole sets are compared outright, but for one shingle in case two have the same 32 bits. Otherwise the
    hashes up to the smaller of the two last ones are a sample of both sets, all shared ones among them.
    """
    x, y = F.col(a), F.col(b)
    both, p = F.size(F.array_intersect(x, y)), percent / 100
    last = lambda c: F.when(F.size(c) == LEAST, F.element_at(c, -1))
    end = F.least(last(x), last(y))
    # one of the sets holds the end; its place among all hashes needs no function of every element
    held = F.array_position(F.sort_array(F.concat(x, y)), end) + F.when(
        F.array_contains(x, end) & F.array_contains(y, end), 1).otherwise(0)
    return F.when((F.size(x) < LEAST) & (F.size(y) < LEAST),
                  (100 + percent) * both >= percent * (F.size(x) + F.size(y)) - 100).otherwise(
        (1 + p) * both >= p * held - MARGIN * F.sqrt(p * (1 - p) / (1 + p) * held))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id it is connected with.

    Contraction: in every round each node points at the least of its closed neighbourhood under a
    fresh random order, edges move to those targets, loops go. A constant share of nodes
    disappears per round whatever the shape, so chains and stars both take O(log n) rounds.
    Hubs are only ever reduced by a partial minimum.
    """
    with passing() as keep:
        return keep(_components(edges, label))


def _components(edges: DataFrame, label: str) -> DataFrame:
    edges = store(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), f"{label}-edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        seed = F.lit(len(steps))
        order = lambda c: F.struct(F.xxhash64(c, seed).alias("h"), F.col(c).alias("v"))
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("w")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("w")))
        least = both.select("u", order("w").alias("o")).groupBy("u").agg(F.min("o").alias("o"))
        step = store(least.select("u", F.least("o", order("u"))["v"].alias("to")), f"{label}-step")
        steps.append(step)
        moved = edges
        for side in ("a", "b"):
            moved = moved.join(step.select(F.col("u").alias(side), F.col("to").alias(f"{side}_to")), side)
        edges = store(moved.where("a_to <> b_to").select(
            F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), f"{label}-edges")
    if not steps:
        return store(edges.select(F.col("a").alias("id"), F.col("b").alias("component")), f"{label}-named")
    root = steps[0].select(F.col("u").alias("id"), F.col("to").alias("root"))
    for step in steps[1:]:
        root = root.join(step.select(F.col("u").alias("root"), "to"), "root", "left").select(
            "id", F.coalesce("to", "root").alias("root"))
    root = store(root, f"{label}-roots")
    names = root.groupBy("root").agg(F.min("id").alias("component"))
    return store(root.join(names, "root").select("id", "component"), f"{label}-named")


def linked_components(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], label: str,
                      traits: DataFrame | Callable[[DataFrame], DataFrame], likely: Callable[[str, str], Column],
                      deal_once: bool = False, coarse: tuple[DataFrame, Callable[[str, str], Column]] | None = None,
                      exact: Callable[[str, str], Column] | None = None) -> DataFrame:
    """Components of all pairs that share a bucket and that ``verify`` confirms.

    ``buckets``: (key, id), distinct ids per key. ``verify`` maps pairs (a, b) to the confirmed ones.
    First every member is compared with its bucket's head, the member that meets most others over all buckets
    (a text that others were made from is nearer to each of them than they are to one another): as many
    pairs as rows.
    Then, in buckets that still hold several components, everything outside the bucket's largest
    component is compared with every member of another component. Two members that are already
    connected are never compared, so a large group of copies costs no square of its size, and no
    link that could join two components is left untested. There the join itself drops pairs that are not
    ``likely(prefix, prefix)`` by their ``traits`` (id, ...; columns are prefixed), so that texts which merely
    share a passage make no rows. Traits that cost something may be a function from the ids (id) that are left;
    ``coarse``, cheaper traits and their condition, leaves the members that could have a partner at all, by a semi join. ``deal_once`` shuffles the buckets once by key
    instead of once reduced and once whole, for when they are many times larger than their groups.

    ``exact``, a condition on the traits that says what ``verify`` says, takes its place after the first pass: members
    are joined to components by semi joins (``_rounds``), so that what is made grows with the members, not with their pairs.
    """
    with passing() as keep:
        return keep(_linked_components(buckets, verify, label, traits, likely, deal_once, coarse, exact))


def _dealt(rest: DataFrame, others: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with a ``salt``: a large bucket's ``rest`` is dealt over several tasks, each of which gets the ``others``."""
    spread = whole.groupBy("key").agg(F.ceil(F.count("*") / _BUCKET_ROWS).cast("int").alias("tasks"))
    rest = rest.join(spread, "key").withColumn("salt", F.pmod(F.xxhash64("x"), "tasks").cast("int")).drop("tasks")
    others = others.join(spread, "key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).drop("tasks")
    return rest, others


def _rounds(mixed: DataFrame, traits: DataFrame, exact: Callable[[str, str], Column], named: DataFrame, label: str) -> DataFrame:
    """``named`` with the components joined that hold an ``exact`` pair of members (key, id, c, main) of one bucket.

    A round asks, for every member outside its bucket's largest component, whether that holds a partner; a semi join ends with
    the first one. That settles all pairs with the largest component, whose members leave; the others go on under the
    names the round gave them. What is left after ``_ROUNDS`` rounds, the small components of a bucket, meets in pairs.
    """
    own = [c for c in traits.columns if c != "id"]

    def known(members: DataFrame, side: str) -> DataFrame:
        # traits are wide: they come last, so that they are shuffled once by id and once to meet
        return members.join(traits, F.col(side) == F.col("id")).select(*members.columns, *[F.col(t).alias(f"{side}_{t}") for t in own])

    for turn in range(_ROUNDS + 1):
        rest = mixed.select("key", F.col("id").alias("x"), F.col("c").alias("cx"), "main")
        others = mixed.select("key", F.col("id").alias("y"), F.col("c").alias("cy"), F.col("main").alias("y_main"))
        if turn < _ROUNDS:
            x, y = _dealt(rest.where("cx <> main"), others.where("cy = y_main").drop("y_main", "cy"), mixed)
            pairs = known(x, "x").join(known(y, "y").withColumnsRenamed({"key": "y_key", "salt": "y_salt"}),
                                       (F.col("key") == F.col("y_key")) & (F.col("salt") == F.col("y_salt")) & exact("x_", "y_"), "left_semi")
            edges = pairs.select(F.col("cx").alias("a"), F.col("main").alias("b"))
        else:
            x, y = _dealt(rest, others.drop("y_main"), mixed)
            edges = known(x, "x").join(known(y, "y"), ["key", "salt"]).where("cx <> cy and x < y").where(exact("x_", "y_")).select(
                F.col("cx").alias("a"), F.col("cy").alias("b"))
        joined = components(edges, f"{label}-joined")
        to = joined.select(F.col("id").alias("c"), F.col("component").alias("to"))
        # a component's name is one of its members, so a name that is no member is a member on its own
        alone = joined.join(named.select("id"), "id", "left_anti")
        named = store(named.withColumnRenamed("component", "c").join(to, "c", "left").select(
            "id", F.coalesce("to", "c").alias("component")).unionByName(alone), f"{label}-named")
        if turn == _ROUNDS:
            break
        left = mixed.where("c <> main").join(to, "c", "left").select("key", "id", F.coalesce("to", "c").alias("c"))
        sizes = left.groupBy("key", "c").agg(F.count("*").alias("n"))
        main = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("c", F.struct("n", "c")).alias("main"))
        mixed = store(left.join(main.where("parts > 1").select("key", "main"), "key"), f"{label}-mixed")
        if mixed.isEmpty():
            break
    return named


def _linked_components(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], label: str,
                       traits: DataFrame | Callable[[DataFrame], DataFrame], likely: Callable[[str, str], Column],
                       deal_once: bool, coarse: tuple[DataFrame, Callable[[str, str], Column]] | None,
                       exact: Callable[[str, str], Column] | None) -> DataFrame:
    if deal_once:
        buckets = buckets.repartition("key")
    groups = buckets.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
    members = store(buckets.join(groups.where("low < high").select("key", "n"), "key"), f"{label}-members")
    meets = members.groupBy("id").agg(F.sum("n").alias("meets"))
    heads = members.join(meets, "id").groupBy("key").agg(F.max_by("id", F.struct("meets", "id")).alias("head"))
    first = members.join(heads, "key").where("id <> head")
    first = store(first.select(F.least("head", "id").alias("a"), F.greatest("head", "id").alias("b")).distinct(),
                  f"{label}-pairs")
    with passing() as keep:
        good = keep(store(verify(first).select("a", "b"), f"{label}-links"))
    named = components(good, label)

    placed = members.select("key", "id").join(named, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("c"))
    sizes = placed.groupBy("key", "c").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("c", F.struct("n", "c")).alias("main"))
    mixed = store(placed.join(mixed.where("parts > 1").select("key", "main"), "key"), f"{label}-mixed")
    if coarse is not None:
        cheap, possible = coarse
        known = mixed.join(cheap, "id")
        x, y = (known.select("key", *[F.col(c).alias(f"{side}_{c}") for c in known.columns if c != "key"]) for side in "xy")
        crossing = (F.col("x_c") != F.col("y_c")) & ((F.col("x_c") != F.col("x_main")) | (F.col("y_c") != F.col("y_main")))
        x = x.join(y.withColumnRenamed("key", "y_key"), (F.col("key") == F.col("y_key")) & crossing & possible("x_", "y_"),
                   "left_semi")
        mixed = store(x.select("key", *[F.col(f"x_{c}").alias(c) for c in mixed.columns if c != "key"]), f"{label}-sifted")
    if callable(traits):
        traits = traits(store(mixed.select("id").distinct(), f"{label}-left"))
    if exact is not None:
        return _rounds(mixed, traits, lambda a, b: likely(a, b) & exact(a, b), named, label)
    own = [c for c in traits.columns if c != "id"]
    mixed = mixed.join(traits, "id")
    rest = mixed.where("c <> main").select(
        "key", F.col("id").alias("x"), F.col("c").alias("cx"), *[F.col(t).alias(f"x_{t}") for t in own])
    others = mixed.select("key", "id", "c", "main", *[F.col(t).alias(f"y_{t}") for t in own])
    on = ["key"]
    if coarse is not None:
        on, (rest, others) = ["key", "salt"], _dealt(rest, others, mixed)
    # a pair with both sides outside the main component is taken once, by x < id
    crossed = (rest.join(others, on).where("cx <> c and (c = main or x < id)").where(likely("x_", "y_"))
               .select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct())
    second = store(crossed.join(first, ["a", "b"], "left_anti"), f"{label}-pairs")
    if second.isEmpty():
        return named
    more = store(verify(second).select("a", "b"), f"{label}-links")
    if more.isEmpty():
        return named
    return components(good.union(more), label)
