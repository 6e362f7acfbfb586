"""Word and shingle hashes of many texts at once, in numpy, inside tasks.

Texts are joined to one byte array; words are maximal runs of bytes other than space
and ``\\x09-\\x0D`` after lower-casing A-Z.  A word's code is a polynomial over random
byte values modulo 2**64, taken from one running sum, then mixed; a shingle's code mixes
the codes of its words.  Work arrays are bounded by ``blocks``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SHINGLE_WORDS = 5
BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C55)
_VALUES = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACES = np.random.default_rng(20240918).integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown by doubling."""
    global _powers, _inverse
    while len(_powers) < n:
        inv = _U(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            up, down = _powers[-1] * _BASE, _inverse[-1] * inv
            _powers = np.concatenate([_powers, _powers * up])
            _inverse = np.concatenate([_inverse, _inverse * down])
    return _powers, _inverse


def blocks(texts: Sequence[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts as bytes, about ``limit`` bytes each: ``(index of the first, texts)``."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        data = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        held.append(data)
        size += len(data)
        if size >= limit:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def prefix_codes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``[i]`` covers the bytes before ``i``."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * up[:len(data)], out=out[1:])
    return out


def range_codes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed codes of byte ranges; equal bytes give equal codes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


class Words:
    """Word codes of a block of texts.

    ``codes[offset[d]:offset[d + 1]]`` are the words of text ``d``."""

    def __init__(self, texts: list[bytes]):
        flat = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        upper = (flat >= 65) & (flat <= 90)
        flat = flat + upper * np.uint8(32)
        solid = np.empty(len(flat) + 1, dtype=bool)
        solid[0] = False
        solid[1:] = (flat != 32) & ((flat < 9) | (flat > 13))
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        start, end = edge[0::2], edge[1::2]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.codes = range_codes(prefix_codes(flat), start, end)
        self.offset = np.searchsorted(start, starts)

    def shingles(self, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Shingle codes by text in order of place, and their offsets.

        A text of fewer words has one shingle of all its words, one without words none."""
        n = len(self.codes)
        lengths = np.diff(self.offset)
        counts = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
        offset = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(offset[-1], dtype=np.uint64)
        if n >= width:
            whole = self.codes[:n - width + 1] * _PLACES[0]
            for j in range(1, width):
                whole += self.codes[j:n - width + 1 + j] * _PLACES[j]
            long = lengths >= width
            place = np.repeat(self.offset[:-1][long] - offset[:-1][long], counts[long])
            at = np.flatnonzero(np.repeat(long, counts))
            out[at] = mix(whole[at + place])
        for d in np.flatnonzero((lengths > 0) & (lengths < width)):
            part = self.codes[self.offset[d]:self.offset[d + 1]]
            out[offset[d]] = mix(np.array([(part * _PLACES[:len(part)]).sum() ^ _U(len(part))], dtype=np.uint64))[0]
        return out, offset


def sequence_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """Code of every run of ``size`` words (fewer than a shingle), as ``shingles`` codes a short text."""
    n = len(codes) - size + 1
    whole = codes[:n] * _PLACES[0]
    for j in range(1, size):
        whole += codes[j:j + n] * _PLACES[j]
    return mix(whole ^ _U(size))


def distinct_shingles(texts: list[bytes], width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle codes of each text, and their offsets."""
    codes, offset = Words(texts).shingles(width)
    keep = np.ones(len(codes), dtype=bool)
    for d in range(len(texts)):
        part = codes[offset[d]:offset[d + 1]]
        part.sort()
    keep[1:] = codes[1:] != codes[:-1]
    firsts = offset[:-1][np.diff(offset) > 0]
    keep[firsts] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], total[offset]
