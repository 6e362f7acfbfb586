"""Lempel-Ziv phrase fingerprints.

A text is parsed into LZ78 phrases (each the shortest string not yet in the text's
dictionary); the phrase set is hashed and summarised by ``SLOTS`` minimum hashes of 16
bits.  The share of equal slots estimates the Jaccard similarity of the phrase sets, a
likeness in the manner of compression distances.  Equal texts have equal fingerprints.

``neighbour_likeness`` compares each document with the next one (ascending ``doc_id``,
after the last the first) and with its edited text, whose last half is the start of the next
document's.  Texts are shuffled once, into id ranges; the first document of each range is also
sent to the range before it.

Edge cases: a null text counts as empty; an empty text has the all-zero fingerprint and
likeness 1 to an empty text, 0 to any other; a table of one document is its own next; rows
of equal ``doc_id`` are ordered by text, a null id comes first; texts are read whole; an empty
table gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordered, textcodes

SLOTS = 64
CHUNK_CHARS = 1 << 19
_U = np.uint64
_rng = np.random.default_rng(909)
_SCALE = _rng.integers(1, 1 << 63, SLOTS, dtype=np.uint64) * _U(2) + _U(1)
_SHIFT = _rng.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def parse(text: str, phrases: dict[str, None], open_phrase: str = "") -> str:
    """Go on parsing: adds the new phrases in order, gives the unfinished one."""
    p = open_phrase
    for c in text:
        p += c
        if p not in phrases:
            phrases[p] = None
            p = ""
    return p


def phrase_lengths(kept: str, rest: str, new_rest: str | None) -> tuple[list[int], list[int]]:
    """Lengths of the phrases of ``kept + rest`` and of ``kept + new_rest``; ``kept`` is parsed once."""
    phrases: dict[str, None] = {}
    p = parse(kept, phrases)
    edited: list[int] = []
    if new_rest is not None:
        other = dict(phrases)
        parse(new_rest, other, p)
        edited = list(map(len, other))
    parse(rest, phrases, p)
    return list(map(len, phrases)), edited


def fingerprints(texts: list[str], lengths: list[list[int]]) -> np.ndarray:
    """Rows of ``SLOTS`` 16-bit minimum hashes; phrases are consecutive in their texts."""
    out = np.zeros((len(texts), SLOTS), dtype=np.uint16)
    full = [i for i, own in enumerate(lengths) if own]
    if not full:
        return out
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    values = textcodes.mix(points.astype(np.uint64) + _U(1))
    up, down = textcodes.powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(points)], out=sums[1:])
    first = np.cumsum([0] + [len(t) for t in texts])
    counts = np.array([len(lengths[i]) for i in full])
    size = np.concatenate([np.array(lengths[i], dtype=np.int64) for i in full])
    run = np.cumsum(size) - size
    starts = np.cumsum(counts) - counts
    start = run + np.repeat(first[full] - run[starts], counts)
    codes = textcodes.mix((sums[start + size] - sums[start]) * down[start])
    for s in range(SLOTS):
        low = np.minimum.reduceat(codes * _SCALE[s] + _SHIFT[s], starts)
        out[full, s] = (textcodes.mix(low) >> _U(48)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray, a_empty: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    """Share of equal slots, row by row."""
    same = (a == b).mean(axis=1)
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), same)


def fingerprint(text: str | None) -> str:
    """Fingerprint of one text as hex digits."""
    text = text or ""
    return fingerprints([text], [phrase_lengths(text, "", None)[0]])[0].astype(">u2").tobytes().hex()


def compare_chain(rows: list[tuple]) -> pa.RecordBatch:
    """Result rows of ``rows[:-1]``, each with the next row ``(doc_id, text)``."""
    ids, texts = [r[0] for r in rows[:-1]], [r[1] for r in rows]
    lengths, edited, edited_lengths = [], [], []
    for t, u in zip(texts, texts[1:]):
        half = len(t) // 2
        kept, rest, new = t[:len(t) - half], t[len(t) - half:], u[:half]
        own, other = phrase_lengths(kept, rest, new)
        lengths.append(own)
        edited.append(kept + new)
        edited_lengths.append(other)
    lengths.append(phrase_lengths(texts[-1], "", None)[0])
    prints, edited_prints = fingerprints(texts, lengths), fingerprints(edited, edited_lengths)
    empty = np.array([not t for t in texts])
    edited_empty = np.array([not t for t in edited], dtype=bool)
    columns = [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
        pa.array([p.astype(">u2").tobytes().hex() for p in prints[:-1]], pa.string()),
        pa.array([p.astype(">u2").tobytes().hex() for p in edited_prints], pa.string()),
        pa.array(likeness(prints[:-1], edited_prints, empty[:-1], edited_empty), pa.float64()),
        pa.array(likeness(prints[:-1], prints[1:], empty[:-1], empty[1:]), pa.float64())]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def neighbour_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints and likenesses of every document (``SCHEMA``)."""
    n = ordered.shuffle_partitions(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       ordered.order_key(F.col("doc_id")).alias("key"))
    at = ordered.cuts(docs, n)
    ranged = rows.withColumn("range", ordered.range_of(F.col("key"), at)).withColumn("tail", F.lit(False))
    # one id a range: bounded by the number of shuffle partitions
    firsts = sorted(ranged.groupBy("range").agg(F.min("key").alias("key")).collect())
    after = [(firsts[i]["range"], firsts[(i + 1) % len(firsts)]["key"]) for i in range(len(firsts))]
    schema = "range int, key bigint"
    tails = rows.join(F.broadcast(docs.sparkSession.createDataFrame(after, schema)), "key") \
        .select("doc_id", "text", "key", "range", F.lit(True).alias("tail"))
    dealt = ordered.deal(ranged.unionByName(tails), n, "range", "tail", "key", "text")

    def scan(batches):
        held: list[tuple] = []
        size, closed = 0, False
        for batch in batches:
            ids, texts, tails = (batch.column(c).to_pylist() for c in ("doc_id", "text", "tail"))
            for doc_id, text, tail in zip(ids, texts, tails):
                if closed:  # further rows of the id that is next
                    continue
                closed = tail
                held.append((doc_id, text))
                size += len(text)
                if len(held) > 1 and size >= CHUNK_CHARS:
                    yield compare_chain(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield compare_chain(held)

    return dealt.select("doc_id", "text", "tail").mapInArrow(scan, SCHEMA)
