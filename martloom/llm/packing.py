"""Best-fit packing of tokenized documents into fixed-length sequences, certified by bounds.

``token_pieces`` cuts documents into pieces; ``packed`` deals the pieces to partitions, packs each by
best-fit decreasing and computes a lower bound for its number of sequences from dual feasible
functions. A partition that reaches its bound is certified. The others put all sequences that have
room left into an exchange: those are dealt anew, whole sequence by whole sequence, to mixed pools,
which rerun best-fit decreasing; a pool keeps the better of its old and new packing. Rounds go on
until all is certified, a round gains nothing, or ``rounds`` is reached.

Rows: a null or empty text is the end token alone. Repeated rows are packed as often as they occur; a
null ``doc_id`` is carried along. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import map_columns, read, store

CAPACITY = 1024
END_TOKEN = 2
#: Pieces per partition of one best-fit run; a partition's rows (some tens of bytes each) meet in one task.
PARTITION_PIECES = 100_000
ROUNDS = 4
_YIELD_BYTES = 8 << 20
_BIN_BITS = 24
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary())])
_SPECIAL = "<|endoftext|>"
_SPECIAL_ID = 50256


class Encoder:
    """Token ids of the vocabulary file ``name``.tiktoken, equal to those of ``name``.json.

    The split pattern's look-ahead only matters where white space repeats; texts without such runs
    take an equivalent pattern without it, which matches in linear time.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        whole = public_tokenizers.PATTERN
        make = lambda label, p: tiktoken.Encoding(
            label, pat_str=p, mergeable_ranks=ranks, special_tokens={_SPECIAL: _SPECIAL_ID})
        self._whole = make("whole", whole)
        self._plain = make("plain", whole.replace(r"|\s+(?!\S)|\s+", r"|\s"))
        self._run = re.compile(r"\s\s")

    def ids(self, text: str) -> list[int]:
        if _SPECIAL in text:  # read as the special token, as the vocabulary's own file does
            return self._whole.encode(text, allowed_special="all")
        return (self._whole if self._run.search(text) else self._plain).encode_ordinary(text)


def _cutter(capacity: int):
    def start():
        encoder = Encoder()

        def cut(batch: dict) -> Iterator[dict]:
            out, held = {name: [] for name in PIECES.names}, 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.ids(text or "")
                ids.append(END_TOKEN)
                whole = array("I", ids).tobytes()
                at, piece, end = 0, 0, len(ids) % capacity or min(capacity, len(ids))
                while at < len(ids):
                    for name, value in zip(PIECES.names, (doc_id, piece, at, end - at, whole[4 * at:4 * end])):
                        out[name].append(value)
                    at, end, piece = end, end + capacity, piece + 1
                held += len(whole)
                if held >= _YIELD_BYTES:
                    yield out
                    out, held = {name: [] for name in PIECES.names}, 0
            yield out

        return cut

    return start


def token_pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids): token ids as little-endian unsigned 32-bit values.

    A longer document is cut from its end into full pieces; only its first piece may be shorter.
    """
    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), _cutter(capacity), PIECES)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest bins that can hold ``lengths``: the best of several dual feasible functions."""
    counts = np.bincount(lengths, minlength=capacity + 1).astype(object)
    x = np.arange(capacity + 1)
    best = 0
    for a in range(capacity // 2 + 1):  # drop what is below a, round up what leaves less than a
        weight = np.where(x > capacity - a, capacity, np.where(x >= a, x, 0))
        best = max(best, -(-int((counts * weight).sum()) // capacity))
    for k in range(1, 33):  # stepwise rounding by k + 1
        exact = (k + 1) * x % capacity == 0
        weight = np.where(exact, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((counts * weight).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of every length, and the room left in each bin."""
    bins, offsets, room = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has exactly r left
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        fits = open_rooms >> need
        if fits:
            left = need + (fits & -fits).bit_length() - 1
            b = by_room[left].pop()
            if not by_room[left]:
                open_rooms ^= 1 << left
        else:
            b, left = len(room), capacity
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        room[b] = left - need
        by_room[left - need].append(b)
        open_rooms |= 1 << (left - need)
    return bins, offsets, room


def _pack_group(capacity: int, round_no: int, columns: list[str]):
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        lengths, old = rows["length"].to_numpy(), rows["sequence_id"].to_numpy()
        bins, offsets, room = best_fit(lengths, capacity)
        bound, before, used = lower_bound(lengths, capacity), len(np.unique(old)), len(room)
        moved = round_no == 0 or used < before
        if moved:
            placed = ((key[0].as_py() << _BIN_BITS) + bins, offsets, np.asarray(room)[bins])
        else:
            placed, used = tuple(rows[c].to_numpy() for c in ("sequence_id", "offset", "room")), before
        new = dict(zip(("sequence_id", "offset", "room"), map(pa.array, placed)))
        new["gap"] = pa.array(np.full(len(lengths), used - bound))
        new["moved"] = pa.array(np.full(len(lengths), moved))
        return pa.table({c: new.get(c, rows[c]) for c in columns})

    return pack


def packed(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS,
           partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` (with a ``length`` from 1 to ``capacity``) plus sequence_id, offset.

    ``sequence_id`` is unique per sequence; offsets in a sequence are gapless from 0.
    """
    columns = pieces.columns
    zero = F.lit(0).cast("long")
    rows = store(pieces.withColumns({
        "spread": F.xxhash64(*[F.col(c) for c in columns]), "sequence_id": zero, "offset": zero, "room": zero,
        "gap": zero, "moved": F.lit(True)}), "pieces")
    schema, n = rows.schema, rows.count()
    groups = max(1, -(-n // partition_pieces))
    settled, first_group = [], 0
    for round_no in range(rounds + 1):
        what = "spread" if round_no == 0 else "sequence_id"  # an exchange moves whole sequences
        group = F.pmod(F.xxhash64(what, F.lit(round_no)), F.lit(groups)) + first_group
        done = store(rows.withColumn("deal", group).groupBy("deal").applyInArrow(
            _pack_group(capacity, round_no, schema.names), schema), "packed")
        first_group += groups
        loose = (F.col("gap") > 0) & (F.col("room") > 0)
        left, gained = done.agg(F.count_if(loose), F.max("moved")).first()
        if not left or not gained or round_no == rounds:
            settled.append(done)
            break
        settled.append(done.where(~loose))
        rows, groups = done.where(loose), max(1, -(-left // partition_pieces))
    result = settled[0]
    for more in settled[1:]:
        result = result.union(more)
    return result.select(*columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packed(pieces)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 1024 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"))
