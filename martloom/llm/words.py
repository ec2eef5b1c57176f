"""Words and five-word shingles as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_CACHE_ROWS = 500_000
# Odd multipliers of the positions in a shingle, and of the finalizer.
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F], dtype=np.uint64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; forgets everything when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_ROWS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a UTF-8 text.

    A-Z are lower-cased; words are runs without ASCII white space. A text of fewer words has the
    whole sequence as its one shingle; a text without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    if len(h) < WORDS:
        total = (h * _PLACE[:len(h)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(h))
        return mixed(total)
    n = len(h) - WORDS + 1
    total = h[:n] * _PLACE[0]
    for i in range(1, WORDS):
        total += h[i:i + n] * _PLACE[i]
    return np.unique(mixed(total))
