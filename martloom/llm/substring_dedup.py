"""Removal of repeated byte strings by suffix arrays of shards.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a smaller doc_id, or earlier in the same
document) goes. Matches never cross documents; strings are judged on the input.

1. Documents equal to one of a smaller doc_id are set apart: all their strings start earlier.
2. Each window of ``LENGTH`` bytes is anchored at the ``ANCHOR``-byte string of least hash in it (the first, if equal).
   Equal windows have equal anchors, so the windows between two changes of anchor form a segment, and equal
   windows lie in segments of one anchor: anchors deal segments to shards, which no window is split by.
3. Segments travel as positions and hashes. Equal segments are reduced to the first one, in the batch where they are
   made and then in their shard; anchors with one distinct segment hold no other repeats.
4. The bytes of the remaining segments form the shard texts. Each gets its suffix array by induced sorting and its
   permuted common prefixes; windows whose neighbours share ``LENGTH`` bytes form groups, of which the first stays.
5. Documents lose the union of what was found.

Segments and anchors are compared by 64-bit hashes (equal segments by 128 bits), windows byte by byte.

Rows: a null or empty text has no bytes. A null ``doc_id`` is left whole and takes no part. Rows that share a ``doc_id``
and the text are one document given twice: the same start is no earlier start. Different texts of one ``doc_id`` are
different documents, in the order of their hashes. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import map_columns, marked, read, store
from martloom.llm.suffix_array import common_prefixes, suffix_array
from martloom.llm.words import mixed

LENGTH, ANCHOR = 100, 48
_SPAN = LENGTH - ANCHOR + 1
#: Bytes of texts per shard of segment positions, and bytes per suffix array, that shards aim at.
SHARD_BYTES, TEXT_BYTES = 16 << 20, 2 << 20
_CHUNK = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
DEALT = pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("texts_1", pa.binary()), ("texts_2", pa.binary()),
                   ("docs", pa.binary()), ("starts", pa.binary()), ("windows", pa.binary()), ("repeat", pa.binary())])
#: A run of ``windows`` windows from ``start`` of a document: to be removed, or (key not null) to be sorted.
FOUND = "doc_id long, start long, windows int, key long"
CUT = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])


class Rolling:
    """Hashes of substrings from prefix sums modulo 2**64."""

    def __init__(self):
        self._up = self._down = np.ones(1, np.uint64)

    def prefix(self, text: np.ndarray, salt: int) -> np.ndarray:
        n = len(text) + 1
        if len(self._up) < n:
            size = max(n, 1 << 16)
            steps = np.full(size, _BASE, np.uint64)
            steps[0] = 1
            back = np.full(size, _INVERSE, np.uint64)
            back[0] = 1
            self._up, self._down = np.multiply.accumulate(steps), np.multiply.accumulate(back)
        out = np.zeros(n, np.uint64)
        values = mixed(np.arange(salt, salt + 256, dtype=np.uint64))[text]
        np.cumsum(values * self._up[:n - 1], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed((prefix[last] - prefix[first]) * self._down[first] + (last - first).astype(np.uint64))


def anchors(text: np.ndarray, rolling: Rolling, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every anchor string, and for each window the position of its anchor."""
    n = len(text) - ANCHOR + 1
    at = np.arange(n)
    hashes = rolling.between(prefix, at, at + ANCHOR)
    low = (hashes >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)  # ties go to the first
    width = 1
    while 2 * width <= _SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < _SPAN:
        low = np.minimum(low[:width - _SPAN], low[_SPAN - width:])
    return hashes, (low & np.uint64((1 << 24) - 1)).astype(np.int64)


def _pieces(batch: dict) -> Iterator[tuple[list, bytes, list]]:
    """Documents of at least one window, in chunks of text: (doc_ids, joined text, (offset, first byte) of each part)."""
    ids, texts, places, held = [], [], [], 0
    for doc_id, text in zip(batch["doc_id"], batch["text"]):
        # overlapping by LENGTH - 1, so that each window is in one part
        for at in range(0, max(0, len(text or b"") - LENGTH + 1), _CHUNK):
            part = text[at:at + _CHUNK + LENGTH - 1]
            ids.append(doc_id)
            places.append((held, at))
            texts.append(part)
            held += len(part)
            if held >= _CHUNK:
                yield ids, b"".join(texts), places
                ids, texts, places, held = [], [], [], 0
    if ids:
        yield ids, b"".join(texts), places


def _first_of_each(keys: list[np.ndarray], docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys, doc and start; where a new combination of keys begins; the number of each row's first row."""
    order = np.lexsort([starts, docs, *reversed(keys)])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, new, np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order


def _dealer(shards: int):
    def start():
        rolling = Rolling()

        def deal(batch: dict) -> Iterator[dict]:
            for ids, joined, places in _pieces(batch):
                text = np.frombuffer(joined, np.uint8)
                one, two = rolling.prefix(text, 1), rolling.prefix(text, 1001)
                hashes, anchor = anchors(text, rolling, one)
                offsets, firsts = (np.array(x, np.int64) for x in zip(*places))
                window = np.arange(len(anchor))
                owner = np.searchsorted(offsets, window, side="right") - 1
                ends = np.r_[offsets[1:], len(text)]
                inside = window + LENGTH <= ends[owner]
                begins = np.flatnonzero(inside & np.r_[True, (anchor[1:] != anchor[:-1]) | ~inside[:-1]])
                last = np.r_[begins[1:], len(anchor)]
                # windows across two documents end a segment
                outside = np.flatnonzero(~inside)
                cut = np.searchsorted(outside, begins)
                stop = np.where(cut < len(outside), outside[np.minimum(cut, max(0, len(outside) - 1))] if len(outside) else 0, len(anchor))
                last = np.minimum(last, np.where(cut < len(outside), stop, len(anchor)))
                count = last - begins
                key = hashes[anchor[begins]]
                body = [rolling.between(p, begins, last + LENGTH - 1) for p in (one, two)]
                docs = np.array(ids, np.int64)[owner[begins]]
                starts = begins - offsets[owner[begins]] + firsts[owner[begins]]
                order, new, first = _first_of_each([key, *body], docs, starts)
                later = ~new & ((docs[order] != docs[order][first]) | (starts[order] != starts[order][first]))
                keep = new | later
                order, repeat = order[keep], later[keep]
                shard = (key[order] % np.uint64(shards)).astype(np.int64)
                by = np.argsort(shard, kind="stable")
                order, repeat, shard = order[by], repeat[by], shard[by]
                edges = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(shard)] if len(shard) else [0]
                columns = (key, *body, docs, starts, count.astype(np.uint8))
                out = {name: [] for name in DEALT.names}
                for a, b in zip(edges[:-1], edges[1:]):
                    out["shard"].append(int(shard[a]))
                    for name, values in zip(DEALT.names[1:-1], columns):
                        out[name].append(values[order[a:b]].tobytes())
                    out["repeat"].append(repeat[a:b].tobytes())
                yield out

        return deal

    return start


def _reduce_shard(rows: pa.Table) -> pa.Table:
    """Runs to remove, and the distinct segments of every anchor that has several."""
    kinds = dict(keys=np.uint64, texts_1=np.uint64, texts_2=np.uint64, docs=np.int64, starts=np.int64, windows=np.uint8, repeat=bool)
    key, one, two, docs, starts, windows, repeat = (
        np.concatenate([np.frombuffer(b, kind) for b in rows[name].to_pylist()]) for name, kind in kinds.items())
    order, new, first = _first_of_each([key, one, two], docs, starts)
    key, docs, starts, windows, repeat = (x[order] for x in (key, docs, starts, windows, repeat))
    gone = repeat | ~new & ((docs != docs[first]) | (starts != starts[first]))
    segment = np.flatnonzero(new)
    anchor = key[segment]
    shared = np.zeros(len(segment), bool)
    same = anchor[1:] == anchor[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    sort = segment[shared]
    pick = np.r_[np.flatnonzero(gone), sort]
    keys = pa.array([None] * int(gone.sum()) + anchor[shared].view(np.int64).tolist(), pa.int64())
    return pa.table({"doc_id": docs[pick], "start": starts[pick], "windows": windows[pick].astype(np.int32), "key": keys})


def _cutter():
    def cut(batch: dict) -> Iterator[dict]:
        out = {name: [] for name in CUT.names}
        for doc_id, text, wanted in zip(batch["doc_id"], batch["text"], batch["wanted"]):
            for w in wanted:
                out["shard"].append(w["shard"])
                out["doc_id"].append(doc_id)
                out["start"].append(w["start"])
                out["bytes"].append(text[w["start"]:w["start"] + w["windows"] + LENGTH - 1])
        yield out

    return cut


def repeated_windows(parts: list[bytes], docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, offset) of the windows in ``parts`` that start earlier in another part; docs and starts place the parts."""
    sizes = np.array([len(p) + 1 for p in parts])
    begins = np.r_[0, np.cumsum(sizes)[:-1]]
    # UTF-8 has no byte above 244: all shift by two, 1 ends a part and 0 the text
    text = np.frombuffer(b"".join(p + b"\0" for p in parts) + b"\0", np.uint8) + np.uint8(2)
    text[begins + sizes - 1] = 1
    text[-1] = 0
    sa = suffix_array(text.astype(np.int64))
    # prefixes may run on behind a part's end where both end alike, but windows lie within parts
    prefixes = common_prefixes(text, sa, LENGTH)
    part = np.repeat(np.arange(len(parts)), sizes)
    offset = np.arange(len(part)) - begins[part]
    fits = np.r_[offset + LENGTH < sizes[part], False]
    linked = (prefixes[sa] >= LENGTH) & fits[sa]
    linked[1:] &= fits[sa[:-1]]
    linked[0] = False
    group = np.cumsum(~linked)
    inside = linked.copy()
    inside[:-1] |= linked[1:]
    rows = np.flatnonzero(inside)
    at, group = sa[rows], group[rows]
    d, p = docs[part[at]], starts[part[at]] + offset[at]
    order = np.lexsort([p, d, group])
    at, group, d, p = at[order], group[order], d[order], p[order]
    new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(group) else at
    later = ~new & ((d != d[first]) | (p != p[first]))
    return part[at[later]], offset[at[later]]


def _sort_shard(rows: pa.Table) -> pa.Table:
    docs, starts = rows["doc_id"].to_numpy(), rows["start"].to_numpy()
    part, offset = repeated_windows(rows["bytes"].to_pylist(), docs, starts)
    order = np.lexsort([offset, part])
    part, offset = part[order], offset[order]
    new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (offset[1:] != offset[:-1] + 1)]) if len(part) else part
    count = np.diff(np.r_[new, len(part)])
    return pa.table({"doc_id": docs[part[new]], "start": starts[part[new]] + offset[new], "windows": count.astype(np.int32),
                     "key": pa.nulls(len(new), pa.int64())})


def removed_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, windows): runs of windows that start earlier elsewhere. ``docs``: doc_id, text (binary)."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = 1 + total // SHARD_BYTES
    dealt = map_columns(docs, _dealer(shards), DEALT)
    found = store(dealt.groupBy("shard").applyInArrow(_reduce_shard, FOUND), "segments")
    sort = found.where("key is not null")
    size = sort.agg(F.sum(F.col("windows") + F.lit(LENGTH))).first()[0] or 0
    texts = 1 + size // TEXT_BYTES
    wanted = sort.groupBy("doc_id").agg(F.collect_list(F.struct(
        F.pmod(F.xxhash64("key"), F.lit(texts)).alias("shard"), "start", "windows")).alias("wanted"))
    wanted = store(wanted, "wanted")
    holders = marked(docs, "doc_id", wanted.select("doc_id")).where("maybe").select("doc_id", "text").join(wanted, "doc_id")
    sorted_ = map_columns(holders, _cutter, CUT).groupBy("shard").applyInArrow(_sort_shard, FOUND)
    return found.where("key is null").select("doc_id", "start", "windows").union(sorted_.select("doc_id", "start", "windows"))


def _remover():
    def remove(batch: dict) -> Iterator[dict]:
        out = {name: [] for name in KEPT.names}
        for doc_id, text, starts, windows in zip(batch["doc_id"], batch["text"], batch["starts"], batch["windows"]):
            text = text or b""
            kept, n_spans = text, 0
            if starts:
                first, count = np.array(starts, np.int64), np.array(windows, np.int64)
                change = np.zeros(len(text) + 1, np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, first + count + LENGTH - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            for name, value in zip(KEPT.names, (doc_id, len(text), n_spans, kept)):
                out[name].append(value)
        yield out

    return remove


KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_spans, kept) per row: the bytes that stay, joined, and how many runs were taken out."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    keys = [F.xxhash64("text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2")]
    keyed = store(rows.where("doc_id is not null").select("doc_id", (F.length("text") >= LENGTH).alias("long"), *keys), "keyed")
    several = keyed.groupBy("doc_id").agg(*[f(k).alias(f"{f.__name__}_{k}") for f in (F.min, F.max) for k in ("k1", "k2")])
    if several.where("min_k1 < max_k1 or min_k2 < max_k2").isEmpty():
        return _without_repeats(rows, keyed)
    # numbers in the order of the ids, one per id and text, take the place of the ids
    by = ["doc_id", "k1", "k2"]
    numbers = keyed.select(*by, "long").distinct().repartitionByRange(*by).sortWithinPartitions(*by)
    numbers = store(numbers.withColumn("number", F.monotonically_increasing_id()), "numbers")
    numbered = rows.where("doc_id is not null").select("doc_id", "text", *keys).join(numbers.select(*by, "number"), by)
    out = _without_repeats(numbered.select(F.col("number").alias("doc_id"), "text"),
                           numbers.select(F.col("number").alias("doc_id"), "long", "k1", "k2"))
    back = numbers.select("number", F.col("doc_id").alias("id"))
    out = out.join(back, F.col("doc_id") == F.col("number")).select(F.col("id").alias("doc_id"), *out.columns[1:])
    return out.union(map_columns(rows.where("doc_id is null").select(
        "doc_id", "text", F.lit(None).cast("array<long>").alias("starts"), F.lit(None).cast("array<long>").alias("windows")), _remover, KEPT))


def _without_repeats(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """``without_repeats`` of ids with one text each; ``keyed``: their (doc_id, long, k1, k2)."""
    keyed = keyed.where("long")
    heads = keyed.groupBy("k1", "k2").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).where("head < last")
    copies = store(keyed.join(heads.select("k1", "k2", "head"), ["k1", "k2"]).where("doc_id > head").select("doc_id").distinct(), "copies")
    split = marked(rows, "doc_id", copies, "copied")
    tested = split.where("copied").join(copies.withColumn("copy", F.lit(True)), "doc_id", "left")
    own = split.where("not copied").select("doc_id", "text").union(tested.where("copy is null").select("doc_id", "text"))
    runs = removed_runs(own.where("doc_id is not null").where(F.length("text") >= LENGTH))
    runs = store(runs.groupBy("doc_id").agg(F.collect_list("start").alias("starts"),
                                            F.collect_list(F.col("windows").cast("long")).alias("windows")), "runs")
    hit = marked(own, "doc_id", runs.select("doc_id"), "hit")
    none = F.lit(None).cast("array<long>")
    whole = hit.where("not hit").select("doc_id", "text", none.alias("starts"), none.alias("windows"))
    some = hit.where("hit").select("doc_id", "text").join(runs, "doc_id", "left")
    kept = map_columns(whole.union(some.select(*whole.columns)), _remover, KEPT)
    gone = tested.where("copy").select("doc_id", F.length("text").cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("n_spans"),
                                       F.lit(b"").alias("kept"))
    return kept.union(gone)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without byte strings of 100 or more that also start earlier."""
    out = without_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))
