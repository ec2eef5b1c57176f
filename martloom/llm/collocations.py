"""Phrase collocations: an FM-index over word ids per shard enumerates n-grams, counts are summed across shards.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks and the pieces into words. A task cuts what it
reads into shards of about ``SHARD_WORDS`` words, between pieces. A shard is indexed by the Burrows-Wheeler
transform of its word ids, with rows sorted by as many words as a phrase may have: for searches of that depth its
intervals are those of the full transform. All intervals are extended at once: those of n + 1 words are what the
extension of the n-word intervals to the left leads to, and each lies within the interval that it extends to the
right, so an n-gram knows both of its (n - 1)-grams.

Only phrases that occur ``LEAST`` times in the whole language matter, and most distinct n-grams occur once. So a first
pass over the shards sums words, pairs and triples by hash: they are dealt to buckets whose number grows with the
input, a bucket's hashes are added up, and those that reach ``LEAST`` set bits in a bitmap of 2**``BITS`` (8 MB,
whatever the input). The second pass gives a word, and extends an interval, only if the n-gram's bit is set. The bitmap
never stops a phrase that is frequent enough, whatever the shard that holds it, and the exact sums of the second pass
decide, so it saves rows and changes none.

Rows: a null text is empty, a null ``lang`` is ``und``; a null or repeated ``doc_id`` does not matter, every row counts.
Empty tables give no phrases. Only ``lang`` and ``text`` are read. A word may hold any character but the
separators; bytes that are no UTF-8 do not occur in Spark's strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import map_columns, read, store
from martloom.llm.words import mixed

DEPTH, LEAST, TOP = 3, 10, 2000
SHARD_WORDS = 3 << 19
BITS = 26
#: Text bytes for each bucket of hashes: about two million of them, which ``LOW_BITS`` bits tell apart but for some.
BUCKET_BYTES, LOW_BITS = 1 << 23, 24
_SALTS = 64
# Characters that end a piece; all become the first one.
_CUTS = b".,;:!?\n\x0b\x0c\r"
_TO_CUT = bytes.maketrans(_CUTS, b"." * len(_CUTS))
_PLACE = mixed(np.arange(11, 11 + DEPTH, dtype=np.uint64)) | np.uint64(1)
SUMS = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("sums", pa.binary())])
GRAMS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n_words", pa.int64()), ("count", pa.int64()),
                   ("left", pa.int64()), ("right", pa.int64())])


class Shard:
    """Word ids of some texts; 0 stands between pieces. Ids tell languages apart."""

    def __init__(self):
        self.ids: dict[tuple[str, bytes], int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, tokens: list[bytes]) -> None:
        ids = self.ids
        out = np.fromiter((0 if t == b"." else ids.setdefault((lang, t), len(ids) + 1) for t in tokens), np.int32,
                          len(tokens))
        self.parts += [out, np.zeros(1, np.int32)]
        self.size += len(out) + 1

    def sequence(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.int32), *self.parts])


def shards(batch_rows: Iterator[tuple[str | None, bytes | None]], limit: int) -> Iterator[Shard]:
    """Shards of about ``limit`` words; only a piece longer than that makes a larger one."""
    shard = Shard()
    for lang, text in batch_rows:
        tokens = (text or b"").lower().translate(_TO_CUT).replace(b".", b" . ").split()
        lang, first = "und" if lang is None else lang, 0
        while len(tokens) - first > limit:
            cut = next((i for i in range(first + limit, len(tokens)) if tokens[i] == b"."), len(tokens))
            shard.add(lang, tokens[first:cut])
            first = cut
            yield shard
            shard = Shard()
        shard.add(lang, tokens[first:])
        if shard.size >= limit:
            yield shard
            shard = Shard()
    if shard.size:
        yield shard


def word_hashes(shard: Shard) -> np.ndarray:
    """Hash of every id's language and word, the same in all shards."""
    seeds: dict[str, int] = {}
    out = np.zeros(len(shard.ids) + 1, np.uint64)
    for (lang, word), i in shard.ids.items():
        seed = seeds.get(lang)
        if seed is None:
            seed = seeds[lang] = xxhash.xxh64_intdigest(lang.encode())
        out[i] = xxhash.xxh64_intdigest(word, seed)
    return out


def gram_hashes(*words: np.ndarray) -> np.ndarray:
    """48-bit hashes of n-grams, given the hashes of their words."""
    total = np.full(len(words[0]), len(words), np.uint64)
    for place, word in zip(_PLACE, words):
        total += word * place
    return mixed(total) >> np.uint64(16)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The upper bits spread over the buckets, the lower ones tell a bucket's hashes apart."""
    return ((hashes >> np.uint64(LOW_BITS)) % np.uint64(buckets)).astype(np.int64)


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint32)


def packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """The lower bits of a bucket's hashes, in order, and their counts.

    The lowest byte of the steps between hashes is as good as random; the others and the counts compress well.
    """
    steps = np.diff(hashes, prepend=np.uint32(0))
    upper = [(steps >> np.uint32(8 * i)).astype(np.uint8).tobytes() for i in range(1, LOW_BITS // 8)]
    rest = (pa.compress(part, codec="zstd", asbytes=True) for part in (*upper, counts.tobytes()))
    return b"".join([steps.astype(np.uint8).tobytes(), *(len(r).to_bytes(4, "little") + r for r in rest)])


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    parts, at = [data[:n]], n
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "little")
        parts.append(pa.decompress(data[at + 4:at + 4 + size], decompressed_size=n, codec="zstd", asbytes=True))
        at += 4 + size
    *steps, counts = (np.frombuffer(part, np.uint8) for part in parts)
    return np.cumsum(sum(s.astype(np.uint32) << np.uint32(8 * i) for i, s in enumerate(steps)), dtype=np.uint32), counts


class FmIndex:
    """Depth-limited FM-index of a sequence of ids in which 0 separates pieces, with 0 at both ends."""

    def __init__(self, ids: np.ndarray, depth: int = DEPTH):
        n, top = len(ids), int(ids.max(initial=0)) + 1
        names = ids.astype(np.int64)
        for ahead in range(1, depth):
            following = np.append(ids[ahead:], np.zeros(min(ahead, n), ids.dtype))
            if ahead > 1:
                names = np.unique(names, return_inverse=True)[1]
            names = names * top + following
        # a shard has far fewer than 2**31 words, so half the bytes do
        self.order = np.argsort(names, kind="stable").astype(np.int32)
        del names
        row = np.empty(n, np.int32)
        row[self.order] = np.arange(n, dtype=np.int32)
        self.first = ids[self.order]
        #: the transform: the word before each row's suffix
        self.before = ids[self.order - 1]
        #: row of the suffix one word shorter, which the step to the left leads back from
        self.shorter = row[(self.order + 1) % n]
        self.ids, self.n = ids, n

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of one word: (first rows, number of each row's interval, -1 where the row starts with 0)."""
        return self._intervals(self.first != 0, self.first)

    def _intervals(self, valid: np.ndarray, *names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that agree in all names and stand together; an interval ends where a row is not valid."""
        new = valid.copy()
        same = valid[1:] & valid[:-1]
        for name in names:
            same &= name[1:] == name[:-1]
        new[1:] &= ~same
        starts = np.flatnonzero(new)
        return starts, np.where(valid, np.cumsum(new, dtype=np.int32) - 1, -1).astype(np.int32)

    def extended(self, inner: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals one word longer than ``inner`` (numbers by row): kept ones by any word before them that leaves
        the beginning a kept one as well."""
        suffix = inner[self.shorter]
        valid = (self.first != 0) & (suffix >= 0) & (inner >= 0)
        valid &= kept[suffix] & kept[inner] if len(kept) else False
        return self._intervals(valid, inner, suffix)

    def count(self, interval: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(interval[interval >= 0], minlength=n)

    def left_extensions(self, interval: np.ndarray, n: int) -> np.ndarray:
        """Occurrences that have a word of the same piece before them."""
        return np.bincount(interval[(interval >= 0) & (self.before != 0)], minlength=n)

    def right_extensions(self, interval: np.ndarray, n: int, size: int) -> np.ndarray:
        """Occurrences of ``size`` words that have a word of the same piece after them."""
        after = self.ids[np.minimum(self.order + size, self.n - 1)]
        return np.bincount(interval[(interval >= 0) & (after != 0)], minlength=n)


def _rows(batch: dict) -> Iterator[tuple[str | None, bytes | None]]:
    return zip(batch["lang"], batch["text"])


def _over_shards(process, limit: int):
    """Task function for ``map_columns``: rows gather until a shard is full, across batches."""

    def start():
        held: list[tuple[str | None, bytes | None]] = []
        size = [0]

        def flush() -> Iterator[dict]:
            rows, held[:], size[0] = list(held), [], 0
            for shard in shards(iter(rows), limit):
                yield from process(shard)

        def step(batch: dict) -> Iterator[dict]:
            for row in _rows(batch):
                held.append(row)
                size[0] += len(row[1] or b"")
                if size[0] >= 6 * limit:  # about so many bytes a word
                    yield from flush()

        return step, flush

    return start


def _gram_counts(buckets: int):
    def process(shard: Shard) -> Iterator[dict]:
        ids, top = shard.sequence().astype(np.int64), len(shard.ids) + 1
        if top == 1:
            return
        at = np.flatnonzero((ids[1:] != 0) & (ids[:-1] != 0))
        own = word_hashes(shard)
        pairs, which, counts = np.unique(ids[at] * top + ids[at + 1], return_inverse=True, return_counts=True)
        hashes = [gram_hashes(own[1:]), gram_hashes(own[pairs // top], own[pairs % top])]
        times = [np.bincount(ids, minlength=top)[1:], counts]
        # a pair that goes on with a third word
        longer = ids[np.minimum(at + 2, len(ids) - 1)]
        triples, counts = np.unique(which[longer != 0] * top + longer[longer != 0], return_counts=True)
        first = pairs[triples // top]
        hashes.append(gram_hashes(own[first // top], own[first % top], own[triples % top]))
        times.append(counts)
        hashes, counts = np.concatenate(hashes), np.minimum(np.concatenate(times), LEAST).astype(np.uint8)
        bucket, low = _bucket(hashes, buckets), _low(hashes)
        order = np.lexsort((low, bucket))
        low, counts, bucket = low[order], counts[order], bucket[order]
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        yield {"bucket": bucket[edges[:-1]], "n": np.diff(edges),
               "sums": [packed(low[a:b], counts[a:b]) for a, b in zip(edges[:-1], edges[1:])]}

    return process


def bitmap_place(bucket: np.ndarray | int, low: np.ndarray) -> np.ndarray:
    """Place in the bitmap of an n-gram's bucket and lower bits."""
    return (mixed(low.astype(np.uint64) + np.uint64(1 << 32) * np.asarray(bucket).astype(np.uint64))
            >> np.uint64(64 - BITS)).astype(np.int64)


def _frequent(part: pa.Table) -> pa.Table:
    """One bucket: the bits of its hashes whose counts sum to ``LEAST``."""
    low, counts = map(np.concatenate, zip(*map(unpacked, part["sums"].to_pylist(), part["n"].to_pylist())))
    order = np.argsort(low, kind="stable")
    low, counts = low[order], counts[order].astype(np.int64)
    edges = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    place = bitmap_place(part["bucket"][0].as_py(), low[edges][np.add.reduceat(counts, edges) >= LEAST])
    words, which = np.unique(place >> 6, return_inverse=True)
    bits = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(bits, which, np.uint64(1) << (place & 63).astype(np.uint64))
    return pa.table({"word": pa.array(words, pa.int64()), "bits": pa.array(bits.view(np.int64), pa.int64())})


def frequent_grams(docs: DataFrame, buckets: int, shard_words: int = SHARD_WORDS) -> np.ndarray:
    """The bitmap: 2**BITS bits in words of 64; at most that many rows come to the driver, 16 bytes each."""
    sums = map_columns(docs, _over_shards(_gram_counts(buckets), shard_words), SUMS)
    words = sums.groupBy("bucket").applyInArrow(_frequent, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _grams(bitmap, buckets: int):
    def process(shard: Shard) -> Iterator[dict]:
        bits = bitmap.value
        ids = shard.sequence()
        index, own, names = FmIndex(ids), word_hashes(shard), [None, *shard.ids]
        # per language all its words, as the phrase without words
        words, counts = np.unique(ids, return_counts=True)
        totals: dict[str, int] = {}
        for w, c in zip(words.tolist(), counts.tolist()):
            if w:
                totals[names[w][0]] = totals.get(names[w][0], 0) + c
        yield {"lang": list(totals), "phrase": [""] * len(totals), "n_words": [0] * len(totals),
               "count": list(totals.values()), "left": [0] * len(totals), "right": [0] * len(totals)}

        def rows(starts: np.ndarray, interval: np.ndarray, size: int, wanted: np.ndarray) -> dict:
            at = index.order[starts[wanted]]
            said = [ids[at + i].tolist() for i in range(size)]
            return {"lang": [names[w][0] for w in said[0]],
                    "phrase": [b" ".join(names[w][1] for w in words).decode() for words in zip(*said)],
                    "n_words": [size] * len(at), "count": index.count(interval, len(starts))[wanted],
                    "left": index.left_extensions(interval, len(starts))[wanted],
                    "right": index.right_extensions(interval, len(starts), size)[wanted]}

        def frequent(starts: np.ndarray, size: int) -> np.ndarray:
            at = index.order[starts]
            hashes = gram_hashes(*[own[ids[at + i]] for i in range(size)])
            place = bitmap_place(_bucket(hashes, buckets), _low(hashes))
            return (bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

        starts, interval = index.words()
        kept = frequent(starts, 1)
        yield rows(starts, interval, 1, np.flatnonzero(kept))
        for size in range(2, DEPTH + 1):
            starts, interval = index.extended(interval, kept)
            kept = frequent(starts, size)
            yield rows(starts, interval, size, np.flatnonzero(kept))

    return process


def phrases(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, phrase, n_words, count, left, right): all phrases of 1 to ``DEPTH`` words that occur ``LEAST`` times or
    more in their language, and per language one row without words that counts all.

    ``left`` and ``right`` count the occurrences that a word of the same piece precedes or follows.
    """
    docs = docs.select("lang", F.col("text").cast("binary").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, size // BUCKET_BYTES)
    bitmap = docs.sparkSession.sparkContext.broadcast(frequent_grams(docs, buckets, shard_words))
    found = map_columns(docs, _over_shards(_grams(bitmap, buckets), shard_words), GRAMS)
    sums = found.groupBy("lang", "phrase", "n_words").agg(*[F.sum(c).alias(c) for c in ("count", "left", "right")])
    return store(sums.where(f"n_words = 0 or count >= {LEAST}"), "phrases")


def collocations(docs: DataFrame, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score."""
    counted = phrases(docs, shard_words)
    count = F.col("count")
    candidates = counted.where("n_words between 2 and 3").select(
        "lang", "phrase", count.alias("a"), F.split("phrase", " ").alias("w"))
    said = lambda first, n: F.array_join(F.slice("w", first, n), " ")
    # a longer candidate takes the place of the phrases in it that occur at most twice as often
    longer = candidates.where(F.size("w") == 3).select(
        "lang", F.explode(F.array(said(1, 2), said(2, 2))).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    stay = candidates.join(longer, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 50 * a").drop("longer")
    cuts = stay.select("lang", "phrase", "a", F.explode(F.when(F.size("w") == 2, F.array(
        F.struct(F.lit(1).alias("k"), said(1, 1).alias("x"), said(2, 1).alias("y")))).otherwise(F.array(
            F.struct(F.lit(1).alias("k"), said(1, 1).alias("x"), said(2, 2).alias("y")),
            F.struct(F.lit(2).alias("k"), said(1, 2).alias("x"), said(3, 1).alias("y"))))).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut.*")
    for part, name in (("x", "l"), ("y", "r")):
        cuts = cuts.join(counted.select("lang", F.col("phrase").alias(part), count.alias(name)), ["lang", part])
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("aa", F.lit(1000000).cast("decimal(38,0)") * wide("a") * wide("a")).withColumn(
        "lr", wide("l") * wide("r")).withColumn("score", F.expr("cast(aa div lr as long)"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least")).select(
        "lang", "phrase", "a", "least.*")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are spread first, so that no task ranks more than a bounded number of them
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(
        F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    totals = counted.where("n_words = 0").select("lang", count.alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations per language of ``documents``."""
    return collocations(read(spark, sf_dir, "documents"))


ORACLE_SQL = """
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents),
worded as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
grams as (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' '))) as phrase
    from worded, (select unnest([1, 2, 3]) as k) as sizes),
f as (select lang, k, phrase, count(*) as c from grams group by all),
totals as (select lang, sum(c)::bigint as n from f where k = 1 group by lang),
candidates as (select lang, k, phrase, c as a, string_split(phrase, ' ') as w from f where k >= 2 and c >= 10),
longer as (
    select lang, phrase, max(a) as a from (
        select lang, w[1] || ' ' || w[2] as phrase, a from candidates where k = 3
        union all select lang, w[2] || ' ' || w[3], a from candidates where k = 3) as inner_pairs
    group by lang, phrase),
stay as (
    select c.* from candidates as c left join longer as g on c.lang = g.lang and c.phrase = g.phrase
    where g.a is null or 100 * g.a < 50 * c.a),
cuts as (
    select lang, phrase, a, 1 as k, w[1] as x, array_to_string(w[2:], ' ') as y from stay
    union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from stay where k = 3),
scored as (
    select t.lang, t.phrase, t.a, t.k, x.c as l, y.c as r,
        ((1000000::hugeint * t.a * t.a) // (x.c::hugeint * y.c))::bigint as score
    from cuts as t join f as x on x.lang = t.lang and x.phrase = t.x join f as y on y.lang = t.lang and y.phrase = t.y),
least_cut as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from least_cut)
select ranked.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score
from ranked join totals on totals.lang = ranked.lang where rank <= 2000
"""
