"""Minimal perfect hashing of distinct integer keys, in numpy.

Keys are hashed into a bit array twice their number; those alone in their place are settled
there, the others go on to a smaller array with another hash, until none is left.  A
key's number is the rank of its bit over all arrays, so ``n`` keys have the numbers ``0 .. n - 1``.
The hash knows nothing of other keys: callers keep the keys by number and compare.
"""

from __future__ import annotations

import numpy as np

from .textcodes import mix

_U = np.uint64
SPREAD = 2


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = mix(np.array([level + 1], dtype=np.uint64) * _U(0x9E3779B97F4A7C15))[0]
    return (mix(keys ^ seed) % _U(size)).astype(np.int64)


class PerfectHash:
    """Numbers of a set of distinct keys (``uint64``)."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # boolean arrays
        self.ranks = []
        before = 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits) - bits)
            before += int(bits.sum())
        self.size = before

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """Of distinct keys; the number of levels follows the keys (a few dozen at most)."""
        left, levels = keys.astype(np.uint64), []
        while len(left):
            size = SPREAD * len(left)
            at = _places(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; of keys outside the set any number or -1."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        open_rows = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(open_rows):
                break
            at = _places(keys[open_rows], level, len(bits))
            hit = bits[at]
            out[open_rows[hit]] = rank[at[hit]]
            open_rows = open_rows[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], dtype="<i8").tobytes()
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8).tolist()
        at, levels = 8 * (n + 1), []
        for size in sizes:
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels)
