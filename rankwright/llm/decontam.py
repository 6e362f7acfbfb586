"""Benchmark decontamination: SimHash windows, multi-index Hamming search, exact check.

For each benchmark item of ``L`` words, every window of ``L`` words of every document is a
candidate.  A window's fingerprint is the 64-bit SimHash of its 5-word shingles, taken
from running sums of the shingles' bits.  The items' fingerprints stand in a multi-index:
8 blocks of 8 bits; two fingerprints within ``RADIUS`` = 23 bits differ in at most 2 bits in
one block at least, so looking up each block with up to 2 bits flipped finds every item
within the radius.  What the index finds within the radius is verified by the weighted
Jaccard similarity of the shingles (weight: occurrences); 0.8 or more is a leak.

Windows that cannot reach the similarity are not fingerprinted: a similarity ``s`` needs
at least ``s`` times the window's shingles to occur in the benchmark at all, which a
running count of shared shingles tells for each window without loss.

SimHash distances scatter: at similarity exactly 0.8 the expected distance is 9.7 bits
(standard deviation 2.9), so about 1 in 100,000 such borderline windows lies outside the
radius; equal passages have distance 0 and are always found.

Scale: documents are only scanned (no shuffle of texts); the benchmark is read in
blocks of at most ``block_items`` items, each sent to the tasks as one bounded index.

Edge cases: null or wordless texts and items match nothing; an item of fewer than five
words is one shingle and matches its exact word sequence; documents shorter than an
item are one window; texts are read whole; repeated rows give equal rows, which are
reported once per (doc_id, item_id) with the best window (ties: the first); empty
tables give an empty result; extra columns are not carried.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcodes

THRESHOLD = 0.8
RADIUS = 23
BLOCK_ITEMS = 2000
SCHEMA = "doc_id bigint, item_id bigint, similarity double, start_word bigint, n_words bigint, hamming bigint"
_FLIPS = np.array([m for m in range(256) if m.bit_count() <= RADIUS // 8], dtype=np.uint8)
_U = np.uint64


def simhash(bit_counts: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Fingerprints from counts of ones (rows x 64) among ``size`` shingles."""
    ones = bit_counts * 2 > (size[:, None] if isinstance(size, np.ndarray) else size)
    return np.packbits(ones, axis=1).view(">u8").ravel().astype(np.uint64)


def bits(codes: np.ndarray) -> np.ndarray:
    """Shingle codes as rows of 64 bits."""
    return np.unpackbits(codes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger number of occurrences."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    low = np.minimum(ca[ia], cb[ib]).sum()
    return float(low / (len(a) + len(b) - low)) if len(a) + len(b) else 0.0


class SizeIndex:
    """Multi-index over the items of one number of words."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        keys, rows = [], []
        for b in range(8):
            value = ((prints >> _U(8 * b)) & _U(255)).astype(np.uint8)
            keys.append((np.int64(b) << 8) | (value[:, None] ^ _FLIPS[None, :]).astype(np.int64))
            rows.append(np.broadcast_to(np.arange(len(prints))[:, None], keys[-1].shape))
        key, row = np.concatenate(keys).ravel(), np.concatenate(rows).ravel()
        order = np.argsort(key, kind="stable")
        self.rows = row[order]
        self.start = np.searchsorted(key[order], np.arange(8 * 256 + 1))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window, item, distance) within ``RADIUS``."""
        pairs = []
        for b in range(8):
            key = (b << 8) | ((prints >> _U(8 * b)) & _U(255)).astype(np.int64)
            lo, n = self.start[key], self.start[key + 1] - self.start[key]
            window = np.repeat(np.arange(len(prints)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            pairs.append(window * len(self.prints) + self.rows[at])
        pair = np.unique(np.concatenate(pairs))
        window, item = np.divmod(pair, len(self.prints))
        distance = np.bitwise_count(prints[window] ^ self.prints[item]).astype(np.int64)
        near = distance <= RADIUS
        return window[near], item[near], distance[near]


class Benchmark:
    """Index of a bounded block of items ``(item_id, text)``."""

    def __init__(self, items: list[tuple], threshold: float = THRESHOLD):
        self.threshold = threshold
        words = textcodes.Words([textcodes_bytes(t) for _, t in items])
        codes, offset = words.shingles()
        by_size = defaultdict(list)
        for i, (item_id, _) in enumerate(items):
            n = int(words.offset[i + 1] - words.offset[i])
            if n and item_id is not None:
                by_size[n].append((item_id, codes[offset[i]:offset[i + 1]]))
        self.sizes: dict[int, tuple] = {}
        for n, own in sorted(by_size.items()):
            counts = np.stack([bits(c).sum(axis=0, dtype=np.int64) for _, c in own])
            self.sizes[n] = ([i for i, _ in own], [c for _, c in own], SizeIndex(simhash(counts, len(own[0][1]))))
        self.known = np.unique(np.concatenate([c for own in by_size.values() for _, c in own] or [np.zeros(0, np.uint64)]))
        self.table = np.zeros(1 << 18, dtype=bool)
        self.table[(self.known & _U((1 << 18) - 1)).astype(np.int64)] = True

    def shared(self, codes: np.ndarray) -> np.ndarray:
        """Which codes occur in the benchmark."""
        hit = self.table[(codes & _U((1 << 18) - 1)).astype(np.int64)]
        at = np.flatnonzero(hit)
        if len(at) and len(self.known):
            place = np.minimum(np.searchsorted(self.known, codes[at]), len(self.known) - 1)
            hit[at[self.known[place] != codes[at]]] = False
        return hit

    def leaks(self, texts: list[bytes]):
        """``(text index, item id, similarity, first word, words, distance)``: best per text and item."""
        words = textcodes.Words(texts)
        codes, offset = words.shingles()
        hits = self.shared(codes)
        total = np.concatenate([[0], np.cumsum(hits)])
        own = np.flatnonzero(total[offset[1:]] > total[offset[:-1]])
        if len(own):
            yield from self._texts(own, codes, hits, offset, np.diff(words.offset))
        yield from self._short(words)

    def _texts(self, own, codes, hits, offset, n_words):
        """Windows of the texts ``own``, all texts of a size together."""
        width = textcodes.SHINGLE_WORDS
        lengths = np.diff(offset)[own]
        take = np.concatenate([np.arange(offset[d], offset[d + 1]) for d in own])
        codes, count = codes[take], np.concatenate([[0], np.cumsum(hits[take])])
        first = np.cumsum(lengths) - lengths
        text = np.repeat(np.arange(len(own)), lengths)
        left = np.repeat(first + lengths, lengths) - np.arange(len(codes))  # shingles from here to the text's end
        sums = np.zeros((len(codes) + 1, 64), dtype=np.int32)
        np.cumsum(bits(codes), axis=0, out=sums[1:])
        for size, (ids, items, index) in self.sizes.items():
            if size < width:
                continue
            # a text shorter than the item is one window
            k = np.minimum(size - width + 1, lengths)[text]
            k[n_words[own][text] < width] = 0
            room = np.flatnonzero((left >= k) & (k > 0))
            start = room[count[room + k[room]] - count[room] >= self.threshold * k[room]]
            if not len(start):
                continue
            size_of = k[start]
            window, item, distance = index.within(simhash(sums[start + size_of] - sums[start], size_of))
            best: dict = {}
            for w, i, h in zip(window.tolist(), item.tolist(), distance.tolist()):
                s, n = int(start[w]), int(size_of[w])
                similarity = weighted_jaccard(codes[s:s + n], items[i])
                if similarity >= self.threshold:
                    t = int(text[s])
                    best[t, i] = min(best.get((t, i), (0.0, 0, 0, 0)), (-similarity, s - int(first[t]), n, h))
            for (t, i), (similarity, s, n, h) in best.items():
                yield int(own[t]), ids[i], -similarity, s, n + width - 1, h

    def _short(self, words):
        """Items of fewer words than a shingle: their exact word sequences."""
        for size, (ids, items, _) in self.sizes.items():
            if size >= textcodes.SHINGLE_WORDS or len(words.codes) < size:
                continue
            found = textcodes.sequence_codes(words.codes, size)
            for item_id, code in zip(ids, items):
                seen = set()
                for at in np.flatnonzero(found == code[0]).tolist():
                    d = int(np.searchsorted(words.offset, at, side="right")) - 1
                    if at + size <= words.offset[d + 1] and d not in seen:
                        seen.add(d)
                        yield d, item_id, 1.0, at - int(words.offset[d]), size, 0


def textcodes_bytes(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def _block_leaks(docs: DataFrame, index: Benchmark) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def scan(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            found: list[list] = [[] for _ in range(6)]
            for first, held in textcodes.blocks(texts):
                for d, *rest in sent.value.leaks(held):
                    for column, value in zip(found, (ids[first + d].as_py(), *rest)):
                        column.append(value)
            names = ["doc_id", "item_id", "similarity", "start_word", "n_words", "hamming"]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(scan, SCHEMA)


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
               block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per (document, item) with a window of similarity ``threshold`` or more (``SCHEMA``)."""
    out, held = None, []

    def flush():
        nonlocal out, held
        if held:
            part = _block_leaks(docs, Benchmark(held, threshold))
            out = part if out is None else out.unionByName(part)
            held = []

    for row in items.select("item_id", "text").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        if len(held) >= block_items:
            flush()
    flush()
    if out is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start_word", "n_words", "hamming"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.round(-F.col("b.s"), 9).alias("similarity"), "b.start_word", "b.n_words", "b.hamming")


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage (a null ``doc_id`` stays)."""
    return docs.join(find_leaks(docs, items, threshold).select("doc_id").distinct(), "doc_id", "left_anti") \
        .select(*docs.columns)
