"""Suffix arrays by induced sorting, and permuted longest common prefixes, for the text of one shard."""

from __future__ import annotations

import numpy as np

#: Up to this alphabet, induction goes bucket by bucket with whole arrays; beyond it, entry by entry.
_BUCKETWISE = 4096


def _smaller_types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last suffix, a unique least symbol, is."""
    n = len(s)
    differs = np.flatnonzero(s[:-1] != s[1:])  # a run takes the type of its end
    out = np.zeros(n, bool)
    out[-1] = True
    if len(differs):
        rising = s[differs] < s[differs + 1]
        starts = np.r_[0, differs[:-1] + 1]
        out[:differs[-1] + 1] = np.repeat(rising, differs - starts + 1)
    return out


def _induce_buckets(s, small, sa, heads, tails):
    """Larger suffixes from left to right, then smaller ones from right to left, a bucket at a time."""
    head, sizes = heads.copy(), tails - heads
    present = np.flatnonzero(sizes)

    def move(found, forward, fill):
        """Put the predecessors of ``found`` (in order) that have the wanted type; give those of the same bucket."""
        before = found[found > 0] - 1
        before = before[small[before] != forward]
        if not len(before):
            return before
        symbols = s[before]
        order = np.argsort(symbols, kind="stable")
        grouped, targets = before[order], symbols[order]
        first = np.flatnonzero(np.r_[True, targets[1:] != targets[:-1]])
        rank = np.arange(len(targets)) - np.repeat(first, np.diff(np.r_[first, len(targets)]))
        at = fill[targets] + rank if forward else fill[targets] - 1 - rank
        sa[at] = grouped
        counts = np.diff(np.r_[first, len(targets)])
        fill[targets[first]] += counts if forward else -counts
        return before

    for c in present:
        at = heads[c]
        while at < head[c]:  # what the bucket got from itself, wave by wave
            upto = head[c]
            move(sa[at:upto], True, head)
            at = upto
        rest = sa[head[c]:tails[c]]
        move(rest[rest >= 0], True, head)
    # the seeds were only needed for the larger suffixes
    tail = tails.copy()
    for c in present[::-1]:
        sa[head[c]:tails[c]] = -1
    for c in present[::-1]:
        at = tails[c]
        while at > tail[c]:
            upto = tail[c]
            move(sa[upto:at][::-1], False, tail)
            at = upto
        move(sa[heads[c]:head[c]][::-1], False, tail)
    sa[0] = len(s) - 1


def _induce_entries(s, small, sa, heads, tails):
    n, symbols, types = len(s), s.tolist(), small.tolist()
    out, head, tail = sa.tolist(), heads.tolist(), tails.tolist()
    seeds = [i for i, v in enumerate(out) if v >= 0]
    for i in range(n):
        j = out[i] - 1
        if j >= 0 and not types[j]:
            c = symbols[j]
            out[head[c]] = j
            head[c] += 1
    for i in seeds:
        if types[out[i]]:
            out[i] = -1
    for i in range(n - 1, -1, -1):
        j = out[i] - 1
        if j >= 0 and types[j]:
            c = symbols[j]
            tail[c] -= 1
            out[tail[c]] = j
    sa[:] = out
    sa[0] = n - 1


def _induced(s, small, seeds, heads, tails):
    """All suffixes in the order that the given order of leftmost-smaller suffixes induces."""
    sa = np.full(len(s), -1, np.int64)
    symbols = s[seeds]
    order = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols, minlength=len(heads))
    starts = tails - counts
    first = np.r_[0, np.cumsum(counts)[:-1]]
    sorted_symbols = symbols[order]
    sa[starts[sorted_symbols] + np.arange(len(order)) - first[sorted_symbols]] = seeds[order]
    (_induce_buckets if len(heads) <= _BUCKETWISE else _induce_entries)(s, small, sa, heads, tails)
    return sa


def _named(s, small, starts, order):
    """Numbers of the leftmost-smaller substrings, in text order, equal ones alike; ``order`` sorts them."""
    n, ends = len(s), np.r_[starts[1:], len(s) - 1]
    end_of = np.zeros(n, np.int64)
    end_of[starts] = ends
    left, right = order[:-1], order[1:]
    same = end_of[left] - left == end_of[right] - right
    active, offset = np.flatnonzero(same), 0
    while len(active):
        a, b = left[active] + offset, right[active] + offset
        equal = (s[a] == s[b]) & (small[a] == small[b])
        same[active[~equal]] = False
        active = active[equal & (a < end_of[left[active]])]
        offset += 1
    name_of = np.zeros(n, np.int64)
    name_of[order] = np.r_[0, np.cumsum(~same)]
    return name_of[starts]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of symbols from 0, of which the last is 0 and occurs once.

    Suffixes are classified as smaller or larger than their successor; the leftmost smaller ones are sorted by
    their substrings up to the next one, recursively where substrings repeat; their order induces all others
    in two linear passes.
    """
    n = len(s)
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    counts = np.bincount(s)
    tails = np.cumsum(counts)
    heads = tails - counts
    small = _smaller_types(s)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sa = _induced(s, small, starts, heads, tails)
    leftmost = np.zeros(n, bool)
    leftmost[starts] = True
    order = sa[leftmost[sa]]
    names = _named(s, small, starts, order)
    if names.max() + 1 < len(starts):
        order = starts[suffix_array(names)]
    return _induced(s, small, order, heads, tails)


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each position the length, up to ``most``, of what its suffix shares with the
    suffix before it in ``sa``. ``text`` holds bytes."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.zeros(n + most + 8, np.uint8)
    padded[:n] = text
    words = np.ndarray((n + most,), "<u8", padded, 0, (1,))  # the eight bytes from every position on
    out = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    for offset in range(0, most, 8):
        differs = words[active + offset] ^ words[before[active] + offset]
        equal = differs == 0
        ended, rest = active[~equal], differs[~equal]
        lowest = rest & (~rest + np.uint64(1))
        out[ended] = offset + (np.log2(lowest.astype(np.float64)) // 8).astype(np.int64)
        active = active[equal]
    out[active] = most
    ends = n - np.maximum(np.arange(n), before)
    return np.minimum(np.minimum(out, most), ends)
