"""Alignment of two tokenizers over a corpus: token groups, links, and how common each link is.

Both tokenizers encode the same bytes: a space and the text.  Tokens of A and B are linked where
their byte ranges overlap, and places where tokens of both end cut them into groups.
A linked id pair's count is the number of documents that hold it.

1. Documents are dealt into shards of about ``SHARD_BYTES``.  A shard aligns its documents and
   gives its distinct pairs with their document counts, cut into ``SLICES`` by the id of A.
2. A slice's distinct pairs are united up a tree (``FAN_IN`` shards a node) and numbered by a minimal
   perfect hash, the keys kept by number.  Counts are summed as dense vectors indexed by
   that hash, up the same tree.  A slice holds all pairs of its ids of A, so the highest count of an
   id is known there.  Pairs are bounded by the two vocabularies, not by the corpus.
3. Every shard is sent the numbers of its own pairs (looked up by hash, keys compared)
   and aligns its documents a second time to add up what their links count.  Nothing is broadcast.

Encoding goes by segments: neither tokenizer has a token across a single space or line feed
between other characters (A's pre-tokenizer cuts there, and no piece of B holds a space after another
character), so texts are cut there and a segment is aligned once while it stays in the
worker's bounded cache.  A text with a segment whose tokens do not spell its bytes is encoded whole.

Edge cases: null and empty texts, and texts that the tokens of A or B do not spell, have no tokens
(zeros, empty digest) and add no pair; strings of special tokens are plain text; rows without ``doc_id`` are
dealt out by their place and are documents of their own, as are rows that share one; an empty table gives an
empty result; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .mph import PerfectHash
from .tokens import byte_level_bytes, cut, spread_out

SHARD_BYTES = 8 << 20
SLICES = 64
FAN_IN = 64
CACHE_SEGMENTS = 300_000
CHUNK_CHARS = 1 << 20
SEGMENTS_AT_ONCE = 2048
_MARKS = ".,;:!?"
_LETTERS = frozenset(c for c in map(chr, range(65, 256)) if c.isalpha() and c not in "\xaa\xb5\xba")
ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
           "groups_sha256 string")
_SPARSE = pa.schema([("slice", pa.int32()), ("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SPARSE_DDL = "slice int, shard bigint, keys binary, counts binary"


class Aligned(NamedTuple):
    """Alignments of some runs of bytes: token, group and link counts of each, the pair keys of all links in order, and
    each run's groups as text."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    keys: np.ndarray
    groups: list[str]


def link(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, run_ends: np.ndarray, base: int,
         with_groups: bool = True) -> Aligned:
    """Align runs that lie one after the other: ids of A and of B with the byte each ends at, and the byte each run ends at
    (an end of both).

    Between two neighbouring token ends of A or B lies one token of each, so every such piece is a link and
    every link such a piece; ends of both close groups.  A pair's key is ``a * base + b``."""
    ends = np.union1d(a_ends, b_ends)
    keys = (a[np.searchsorted(a_ends, ends)] * base + b[np.searchsorted(b_ends, ends)]).astype(np.uint64)
    both = np.intersect1d(a_ends, b_ends, assume_unique=True)
    n_a, n_b, n_links, n_groups = (np.diff(np.searchsorted(x, run_ends, side="right"), prepend=0) for x in (a_ends, b_ends, ends, both))
    if not with_groups:
        return Aligned(n_a, n_b, n_groups, n_links, keys, [""] * len(run_ends))
    cut_a = np.concatenate([[0], np.searchsorted(a_ends, both) + 1]).tolist()
    cut_b = np.concatenate([[0], np.searchsorted(b_ends, both) + 1]).tolist()
    said_a, said_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
    said = [f"{said_a[x]}|{said_b[u]}" if y - x == 1 == v - u else ",".join(said_a[x:y]) + "|" + ",".join(said_b[u:v])
            for x, y, u, v in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
    at = np.concatenate([[0], np.cumsum(n_groups)]).tolist()
    return Aligned(n_a, n_b, n_groups, n_links, keys, [";".join(said[m:n]) for m, n in zip(at, at[1:])])


def fast_form(tokenizer, known: list[bytes]):
    """The same byte-level merges as ranks for tiktoken, which encodes new words faster; None where the tokenizer is of
    another kind (its ids must rise in the order of its merges, and its pre-tokenizer be the usual pattern)."""
    import json

    import public_tokenizers
    import tiktoken
    parts = json.loads(tokenizer.to_str())
    before, model = parts["pre_tokenizer"] or {}, parts["model"]
    usual = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not parts["normalizer"]
    if not usual or model["type"] != "BPE" or model.get("unk_token") or model.get("ignore_merges"):
        return None
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(set(merged)) or len(merged) + 256 != len(model["vocab"]) - sum(t["content"] in model["vocab"] for t in parts["added_tokens"]):
        return None
    added = {t["id"] for t in parts["added_tokens"]}
    ranks = {known[i]: i for i in model["vocab"].values() if i not in added}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def piece_bytes(model) -> list[bytes]:
    """Bytes of each id of a piece model: byte pieces as their byte, U+2581 as a space."""
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


class Aligner:
    """Both tokenizers of a worker, and the alignments of the segments it knows by number.

    Segment 0 stands for texts that the tokens do not spell; it holds nothing."""

    def __init__(self, path_a: str, path_b: str, with_groups: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a_bytes, self.b_bytes = byte_level_bytes(self.a), piece_bytes(self.b)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.base = len(self.b_bytes)
        self.with_groups = with_groups
        self.fast = fast_form(self.a, self.a_bytes)
        pieces = [p.decode("utf-8", "replace") for p in self.b_bytes if len(p) > 1]
        # a piece with a space or line feed inside would join segments: then texts stay whole
        self.whole = any(" " in p.lstrip(" ") or "\n" in p for p in pieces)
        joined = {y for p in pieces for x, y in zip(p, p[1:]) if x in _LETTERS}
        self.marks = "".join(m for m in _MARKS if m not in joined)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        self.counts = [np.zeros((4, 1), np.int64)]  # n_a, n_b, n_groups, n_links of each segment, in parts
        self.keys: list[np.ndarray] = []
        self.groups: list[str] = [""]

    def _a_ids(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(text) if self.fast else self.a.encode(text, add_special_tokens=False).ids

    def _spell(self, data: bytes, a: list[int], b: list[int], run_ends: np.ndarray) -> Aligned | None:
        """Alignment of tokens that spell ``data`` and end where its runs end, else None."""
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        for ends in (a_ends, b_ends):
            if (ends[np.searchsorted(ends, run_ends)] != run_ends).any():
                return None
        return link(a, a_ends, b, b_ends, run_ends, self.base, self.with_groups)

    def _keep(self, found: Aligned) -> list[int]:
        first = len(self.groups)
        self.counts.append(np.stack([found.n_a, found.n_b, found.n_groups, found.n_links]))
        self.keys.append(found.keys)
        self.groups += found.groups
        return list(range(first, len(self.groups)))

    def _add(self, raw: str) -> int:
        """Number of a run that starts with a space, or stands inside a text and starts with a line feed or a mark after a letter."""
        a = self._a_ids(raw)
        # B puts a space in front itself; other runs follow a letter or space, a piece of its own there
        b = self.b.encode(raw[1:] if raw[0] == " " else raw if raw[0] == "\n" else "a" + raw)
        found = self._spell(raw.encode(), a, b if raw[0] == " " else b[1:], np.array([len(raw.encode())]))
        return 0 if found is None else self._keep(found)[0]

    def _add_words(self, words: list[str]) -> list[int]:
        """Numbers of segments without white space inside their ends: encoded as one text, where both tokenizers part them."""
        raw = [w if w[0] == "\n" else " " + w for w in words]
        data = [r.encode() for r in raw]
        text = "".join(raw)
        b = self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]
        found = self._spell(b"".join(data), self._a_ids(text), b, np.cumsum(list(map(len, data))))
        return list(map(self._add, raw)) if found is None else self._keep(found)

    def _learn(self, unknown: list[str]) -> None:
        """Numbers for segments.  Marks after a letter at a segment's end are a run of their own, and the
        segment is put together from both."""
        split, plain = [], set()
        for w in unknown:
            head = w.rstrip(self.marks)
            if len(head) < len(w) and head and head[-1] in _LETTERS:
                split.append((w, head, w[len(head):]))
                plain.add(head)
            else:
                plain.add(w)
        plain.difference_update(self.numbers)
        tails = list({t for _, _, t in split}.difference(self.tails))
        self.tails.update(zip(tails, map(self._add, tails)))
        edges = {w for w in plain if w[-1].isspace() or w[0].isspace() and (w[0] != "\n" or w[1].isspace())}
        rest = list(plain.difference(edges))
        for at in range(0, len(rest), SEGMENTS_AT_ONCE):
            part = rest[at:at + SEGMENTS_AT_ONCE]
            self.numbers.update(zip(part, self._add_words(part)))
        self.numbers.update((w, self._add(w if w[0] in "\n " else " " + w)) for w in edges)
        both = [(w, self.numbers[h], self.tails[t]) for w, h, t in split]
        self.numbers.update((w, 0) for w, h, t in both if not (h and t))
        both = [x for x in both if x[1] and x[2]]
        if both:
            names, heads, ends = zip(*both)
            first = len(self.groups)
            counts, start, links = self.table()
            pair = np.array([heads, ends]).T
            self.counts.append(counts[:, pair].sum(axis=2))
            self.keys.append(links[spread_out(start[pair].ravel(), counts[3, pair].ravel())])
            self.groups += [f"{self.groups[h]};{self.groups[t]}" for h, t in zip(heads, ends)] if self.with_groups else [""] * len(heads)
            self.numbers.update(zip(names, range(first, len(self.groups))))

    def parts(self, text: str) -> list[str]:
        """The segments of a space and the text: one stands for itself if it starts with a line feed or space, else
        for itself after a space."""
        if self.whole:
            return [" " + text]
        out = cut(text)
        if out[0][0] in "\n ":
            out[0] = " " + out[0]
        return out

    def number(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The segments' numbers of all texts, and where each text's begin (one more at the end).

        A text with a segment that the tokens do not spell is encoded whole."""
        if len(self.numbers) > CACHE_SEGMENTS:
            self.forget()
        parted = [self.parts(text) if text else [] for text in texts]
        self._learn(list(set().union(*parted).difference(self.numbers)))
        get = self.numbers.__getitem__
        found, starts = [], [0]
        for text, keys in zip(texts, parted):
            ids = np.fromiter(map(get, keys), np.int64, len(keys))
            if len(ids) and not ids.all():
                whole = self._add(" " + text)
                ids = np.array([whole] if whole else [], np.int64)
            found.append(ids)
            starts.append(starts[-1] + len(ids))
        return np.concatenate(found) if found else np.zeros(0, np.int64), np.array(starts)

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of all segments (4 rows), where each one's links begin, and the keys of the links."""
        self.counts = [np.concatenate(self.counts, axis=1)]
        self.keys = [np.concatenate(self.keys)] if self.keys else []
        counts = self.counts[0]
        return counts, np.cumsum(counts[3]) - counts[3], self.keys[0] if self.keys else np.zeros(0, np.uint64)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each slice ``starts[i]:starts[i + 1]``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner_of(path_a: str, path_b: str, with_groups: bool) -> Aligner:
    """The worker's aligner; its store outlives a task.  One is held at a time."""
    key = (path_a, path_b, with_groups)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def chunks(texts: Sequence[str | None], size: int = CHUNK_CHARS) -> Iterator[Sequence[str | None]]:
    """Runs of texts of about ``size`` characters."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= size or i + 1 == len(texts):
            yield texts[first:i + 1]
            first, held = i + 1, 0


def default_tokenizers() -> tuple[str, str]:
    """Paths of the public byte-level and piece vocabularies (installed on every machine)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def deal(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """Documents with their shard, and the number of shards."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(total // shard_bytes) + 1
    place = F.coalesce(F.col("doc_id"), F.monotonically_increasing_id())
    return rows.withColumn("shard", F.pmod(F.xxhash64(place, F.lit(17)), F.lit(shards))), shards


def shard_pairs(dealt: DataFrame, paths: tuple[str, str], slices: int = SLICES) -> DataFrame:
    """``slice, shard, keys, counts``: the distinct pairs of each shard and in how many of its documents they are."""

    def work(table: pa.Table) -> pa.Table:
        aligner = aligner_of(*paths, False)
        seen: list[np.ndarray] = []
        for texts in chunks(table.column("text").to_pylist()):
            ids, starts = aligner.number(texts)
            counts, first, links = aligner.table()
            used, ids = np.unique(ids, return_inverse=True)
            doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            # each segment of a document once, then each of its pairs once
            once = np.unique((doc << 32) | ids)
            size = counts[3, used]
            keys, pair = np.unique(links[spread_out(first[used], size)], return_inverse=True)
            at = np.cumsum(size) - size
            own = once & 0xFFFFFFFF
            held = np.unique((np.repeat(once >> 32, size[own]) << 32) | pair[spread_out(at[own], size[own])])
            seen.append(np.stack([keys, np.bincount(held & 0xFFFFFFFF, minlength=len(keys)).astype(np.uint64)]))
        found = np.concatenate([np.zeros((2, 0), np.uint64), *seen], axis=1)
        keys, place = np.unique(found[0], return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, place, found[1].astype(np.int64))
        part = (keys // np.uint64(aligner.base)) % np.uint64(slices)
        order = np.lexsort((keys, part))
        keys, counts, part = keys[order], counts[order], part[order]
        edge = np.searchsorted(part, np.arange(slices + 1, dtype=np.uint64))
        shard = table.column("shard")[0].as_py()
        rows = [(s, shard, keys[a:b].tobytes(), counts[a:b].tobytes())
                for s, a, b in zip(range(slices), edge[:-1].tolist(), edge[1:].tolist()) if a < b]
        return pa.Table.from_pylist([dict(zip(_SPARSE.names, r)) for r in rows], schema=_SPARSE)

    return dealt.groupBy("shard").applyInArrow(work, _SPARSE_DDL)


def _one(slice_: int, node: int, **data: bytes) -> pa.Table:
    return pa.table({"slice": pa.array([slice_], pa.int32()), "node": pa.array([node], pa.int64()),
                     **{k: pa.array([v], pa.binary()) for k, v in data.items()}})


def _up_the_tree(rows: DataFrame, nodes: int, column: str, merge: Callable[[list[bytes]], bytes], fan_in: int) -> DataFrame:
    """``slice, <column>``: the values of each slice merged in groups of ``fan_in`` nodes, level by level."""

    def work(table: pa.Table) -> pa.Table:
        value = merge([v.as_py() for v in table.column(column)])
        return _one(table.column("slice")[0].as_py(), table.column("node")[0].as_py(), **{column: value})

    while True:
        nodes = -(-nodes // fan_in)
        rows = rows.withColumn("node", F.pmod("node", F.lit(nodes))).groupBy("slice", "node") \
            .applyInArrow(work, f"slice int, node bigint, {column} binary")
        if nodes == 1:
            return rows.select("slice", column)


def _united(parts: list[bytes]) -> bytes:
    return np.unique(np.concatenate([np.frombuffer(p, np.uint64) for p in parts])).tobytes()


def _summed(parts: list[bytes]) -> bytes:
    total = np.frombuffer(parts[0], np.int64).copy()
    for p in parts[1:]:
        total += np.frombuffer(p, np.int64)
    return total.tobytes()


def verified(hashed: PerfectHash, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Numbers of ``keys``; each must be the key kept under its number."""
    at = hashed.numbers(keys)
    if len(keys) and ((at < 0).any() or (table[at] != keys).any()):
        raise ValueError("a pair was looked up that was never counted: the documents changed between the passes")
    return at


def pair_counts(pairs: DataFrame, shards: int, base: int, fan_in: int = FAN_IN) -> DataFrame:
    """``slice, hash, keys, counts, best``: by number, each pair's key, its document count, and whether none of its
    id of A is higher."""
    nodes = -(-shards // fan_in)
    united = _up_the_tree(pairs.select("slice", F.col("shard").alias("node"), "keys"), shards, "keys", _united, fan_in)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[i].as_py(), np.uint64)
                hashed = PerfectHash.build(keys)
                table = np.empty(len(keys), np.uint64)
                table[hashed.numbers(keys)] = keys
                yield pa.RecordBatch.from_arrays(
                    [batch.column("slice").slice(i, 1), pa.array([hashed.to_bytes()], pa.binary()), pa.array([table.tobytes()], pa.binary())],
                    names=["slice", "hash", "keys"])

    numbered = cut_lineage(united.mapInArrow(number, "slice int, hash binary, keys binary"))

    def dense(key: tuple, sparse: pa.Table, hashes: pa.Table) -> pa.Table:
        if not sparse.num_rows:
            return _one(key[0].as_py(), key[1].as_py(), vector=b"").slice(0, 0)
        hashed = PerfectHash.from_bytes(hashes.column("hash")[0].as_py())
        table = np.frombuffer(hashes.column("keys")[0].as_py(), np.uint64)
        vector = np.zeros(len(table), np.int64)
        for keys, counts in zip(sparse.column("keys"), sparse.column("counts")):
            at = verified(hashed, table, np.frombuffer(keys.as_py(), np.uint64))
            vector[at] += np.frombuffer(counts.as_py(), np.int64)
        return _one(key[0].as_py(), key[1].as_py(), vector=vector.tobytes())

    by_node = numbered.withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nodes - 1).cast("long"))))
    placed = pairs.withColumn("node", F.pmod("shard", F.lit(nodes)))
    vectors = placed.groupBy("slice", "node").cogroup(by_node.groupBy("slice", "node")) \
        .applyInArrow(dense, "slice int, node bigint, vector binary")
    totals = _up_the_tree(vectors, nodes, "vector", _summed, fan_in)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for keys, vector in zip(batch.column("keys"), batch.column("vector")):
                owner = (np.frombuffer(keys.as_py(), np.uint64) // np.uint64(base)).astype(np.int64)
                counts = np.frombuffer(vector.as_py(), np.int64)
                high = np.zeros(int(owner.max(initial=0)) + 1, np.int64)
                np.maximum.at(high, owner, counts)
                flags.append((counts == high[owner]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("slice"), batch.column("hash"), batch.column("keys"), batch.column("vector"), pa.array(flags, pa.binary())],
                names=["slice", "hash", "keys", "counts", "best"])

    return numbered.join(totals, "slice").select("slice", "hash", "keys", "vector") \
        .mapInArrow(best, "slice int, hash binary, keys binary, counts binary, best binary")


def _answers(pairs: DataFrame, counted: DataFrame, shards: int, fan_in: int) -> DataFrame:
    """``shard, keys, counts, best``: what each shard asked, looked up in the slices' tables."""
    nodes = -(-shards // fan_in)
    schema = pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])

    def look_up(key: tuple, asked: pa.Table, tables: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows:
            hashed = PerfectHash.from_bytes(tables.column("hash")[0].as_py())
            table, counts, best = (np.frombuffer(tables.column(c)[0].as_py(), kind) for c, kind in (
                ("keys", np.uint64), ("counts", np.int64), ("best", bool)))
            for shard, keys in zip(asked.column("shard"), asked.column("keys")):
                at = verified(hashed, table, np.frombuffer(keys.as_py(), np.uint64))
                out.append({"shard": shard.as_py(), "keys": keys.as_py(), "counts": counts[at].tobytes(), "best": best[at].tobytes()})
        return pa.Table.from_pylist(out, schema=schema)

    by_node = counted.withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nodes - 1).cast("long"))))
    asked = pairs.select("slice", "shard", "keys").withColumn("node", F.pmod("shard", F.lit(nodes)))
    return asked.groupBy("slice", "node").cogroup(by_node.groupBy("slice", "node")) \
        .applyInArrow(look_up, "shard bigint, keys binary, counts binary, best binary")


def align_corpus(docs: DataFrame, paths: tuple[str, str] | None = None, shard_bytes: int = SHARD_BYTES, slices: int = SLICES,
                 fan_in: int = FAN_IN) -> DataFrame:
    """Alignment summary of every row of ``docs`` (``doc_id, text``): see ``ALIGNED``."""
    paths = paths or default_tokenizers()
    dealt, shards = deal(docs, shard_bytes)
    pairs = cut_lineage(shard_pairs(dealt, paths, slices))
    counted = cut_lineage(pair_counts(pairs, shards, piece_base(paths[1]), fan_in))
    answers = _answers(pairs, counted, shards, fan_in)
    kinds = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                       ("groups_sha256", pa.string())])

    def second_pass(rows: pa.Table, known: pa.Table) -> pa.Table:
        keys, counts, best = (np.concatenate([np.zeros(0, kind), *[np.frombuffer(v.as_py(), kind) for v in known.column(c)]])
                              for c, kind in (("keys", np.uint64), ("counts", np.int64), ("best", bool)))
        order = np.argsort(keys)
        keys, counts, best = keys[order], counts[order], best[order]
        aligner = aligner_of(*paths, True)
        columns: list[list] = [[np.zeros(0, np.int64)] for _ in kinds.names[1:-1]]
        digests: list[str] = []
        for texts in chunks(rows.column("text").to_pylist()):
            ids, starts = aligner.number(texts)
            sizes, first, links = aligner.table()
            used, own = np.unique(ids, return_inverse=True)
            asked = links[spread_out(first[used], sizes[3, used])]
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1) if len(keys) else np.zeros(0, np.int64)
            if len(at) < len(asked) or (keys[at] != asked).any():
                raise ValueError("a pair has no answer: the documents changed between the passes")
            edges = np.concatenate([[0], np.cumsum(sizes[3, used])])
            worth = [sums(best[at].astype(np.int64), edges)[own], sums(counts[at], edges)[own]]
            say = aligner.groups.__getitem__
            bounds, known_ids = starts.tolist(), ids.tolist()
            digests += [hashlib.sha256(";".join(map(say, known_ids[a:b])).encode()).hexdigest() if a < b else "" for a, b in zip(bounds, bounds[1:])]
            for column, values in zip(columns, (*sizes[:, ids], *worth)):
                column.append(sums(values, starts))
        return pa.Table.from_arrays([rows.column("doc_id").cast(pa.int64()).combine_chunks(), *[pa.array(np.concatenate(c)) for c in columns],
                                     pa.array(digests, pa.string())], schema=kinds)

    return dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(second_pass, ALIGNED)


def piece_base(path: str) -> int:
    """Number of ids of a piece model, the base of the pair keys."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
