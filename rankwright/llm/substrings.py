"""Removal of repeated 50-byte strings by suffix order.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller ``doc_id`` is marked; strings are judged on the input, overlaps count, and
matches never cross documents.

Plan.  Documents are dealt once into hash classes of ``doc_id`` (batches); that exchange is
read three times.

1. Each position is a suffix with a head of 50 bytes.  A head's signature is the least
   hash of its 20-byte substrings, so equal heads have equal signatures and neighbours
   mostly share theirs: runs of suffixes.  The distinct signatures of a batch go to
   signature classes (5 bytes each, and the number of runs of those with several), which
   report those found in several batches, and which of them are hot: more than ``HOT_RUNS``
   runs of all batches together.
2. Batches send the runs of shared signatures (their bytes, each distinct run of a batch
   once with its smallest ``doc_id``) to the signature classes.
3. A class orders the suffixes of its runs by deep-shallow sorting; equal heads stand next
   to each other, and each gets the smallest ``doc_id`` of its class.  Back goes one bit
   a suffix: a smaller document has this head.
4. Batches turn bits into removed bytes.  Inside a batch, a run with a document
   smaller than the own one is repeated without asking.

Runs that occur in only one batch, and runs of a signature with one content, need no
ordering.  A passage in very many documents arrives once a batch and content, not once a
document.  Its first and last suffixes share a signature but have other bytes in every
document; that signature is hot, and its suffixes are sent one by one under the code of their
whole head instead.  So a group to be ordered has at most ``HOT_RUNS`` runs, a head arrives
once a batch, and the number of classes follows the bytes of the texts (``CLASS_BYTES``).

Edge cases: null and short texts (under 50 bytes) lose nothing; rows of equal ``doc_id`` never
remove each other's bytes; a null ``doc_id`` takes no part; periodic texts of any length are cut
into runs of 32 suffixes; an empty table gives an empty result; extra columns are not
carried.
"""

from __future__ import annotations

import hashlib
import logging

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordered, textcodes
from .suffixsort import order_heads

LENGTH = 50
GRAM = 20
RUN = 32
BATCH_DOCS = 1024
HOT_RUNS = 4096
CLASS_BYTES = 64 << 20
_U = np.uint64
_log = logging.getLogger(__name__)
_MASK40 = _U((1 << 40) - 1)
PARTS = "class int, batch int, kind int, data binary"
SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


class Runs:
    """Runs of suffixes with one signature, over the texts of a batch block.

    ``start``/``count`` are the first suffix (byte in the joined texts) and number of suffixes;
    ``doc`` the text's index, ``sign`` the signature, ``content`` a code of the run's bytes."""

    def __init__(self, texts: list[bytes]):
        self.flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.first = np.cumsum(lengths) - lengths
        n = len(self.flat)
        empty = np.zeros(0, np.int64)
        self.start, self.count, self.doc = empty, empty, empty
        self.sign = self.content = np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        sums = textcodes.prefix_codes(self.flat)
        _, down = textcodes.powers(len(sums))
        low = textcodes.mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
        span = 1
        reach = LENGTH - GRAM + 1
        while span * 2 <= reach:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:len(low) - (reach - span)], low[reach - span:]) if reach > span else low
        # low[s] is the signature of the suffix at s; only suffixes with a whole head count
        doc = np.repeat(np.arange(len(texts)), lengths)[:len(low)]
        whole = np.arange(len(low)) + LENGTH <= (self.first + lengths)[doc]
        new = np.empty(len(low), dtype=bool)
        new[0] = True
        new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(low)))
        # keep whole suffixes only: they come first in a text, so runs are cut at their end
        room = (self.first + lengths)[doc[begin]] - LENGTH + 1 - begin
        size = np.minimum(size, room)
        begin, size = begin[size > 0], size[size > 0]
        pieces = -(-size // RUN)
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.start = np.repeat(begin, pieces) + piece * RUN
        self.count = np.minimum(np.repeat(size, pieces) - piece * RUN, RUN)
        self.doc, self.sign = doc[self.start], low[self.start]
        self.content = textcodes.range_codes(sums, self.start, self.start + self.count + LENGTH - 1)


    def split(self, chosen: np.ndarray):
        """Each suffix of the chosen runs becomes a run, signed by the code of its head."""
        times = np.where(chosen, self.count, 1)
        source = np.repeat(np.arange(len(times)), times)
        one = chosen[source]
        self.start = self.start[source] + np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
        self.count, self.doc = np.where(one, 1, self.count[source]), self.doc[source]
        self.sign, self.content = self.sign[source], self.content[source]
        begin = self.start[one]
        self.content[one] = textcodes.range_codes(textcodes.prefix_codes(self.flat), begin, begin + LENGTH)
        self.sign[one] = textcodes.mix(self.content[one])
        return self.sign[one]


def _classes(sign: np.ndarray, classes: int) -> np.ndarray:
    return ((sign >> _U(40)) % _U(classes)).astype(np.int64)


def _key(sign: np.ndarray, classes: int) -> np.ndarray:
    """Class and 40 bits of a signature in one number."""
    return (_classes(sign, classes).astype(np.uint64) << _U(40)) | (sign & _MASK40)


class Batch:
    """Texts of a batch in ascending ``doc_id`` order, with their runs."""

    def __init__(self, table: pa.Table, classes: int):
        table = table.sort_by([("doc_id", "ascending")])
        self.ids = table.column("doc_id").to_pylist()
        self.texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in table.column("text").to_pylist()]
        self.classes = classes
        self.blocks: list[tuple[int, Runs]] = []
        held, size, first = [], 0, 0
        for i, (doc_id, t) in enumerate(zip(self.ids, self.texts)):
            held.append(t if doc_id is not None else b"")
            size += len(t)
            if size >= textcodes.BLOCK_BYTES or i + 1 == len(self.texts):
                self.blocks.append((first, Runs(held)))
                held, size, first = [], 0, i + 1

    def all(self, name: str) -> np.ndarray:
        return np.concatenate([getattr(r, name) + (first if name == "doc" else 0) for first, r in self.blocks]
                              or [np.zeros(0, np.uint64)])

    def split(self, hot: np.ndarray) -> np.ndarray:
        """Cuts the runs of hot signatures into suffixes; gives the keys of these."""
        keys = [np.zeros(0, np.uint64)]
        for _, runs in self.blocks:
            chosen = np.isin(_key(runs.sign, self.classes), hot)
            if chosen.any():
                keys.append(_key(runs.split(chosen), self.classes))
        return np.unique(np.concatenate(keys))

    def entries(self, shared: np.ndarray):
        """Distinct runs (signature, content) of shared signatures, by class.

        Gives ``(entry of each run or -1, first run, class and smallest id of each entry)``;
        an entry's first run belongs to its smallest document."""
        sign, content, doc = self.all("sign"), self.all("content"), self.all("doc").astype(np.int64)
        key = _key(sign, self.classes)
        keep = np.isin(key, shared)
        # a signature in several texts of the batch may matter without other batches: same entry rule
        order = np.lexsort((content, key))
        order = order[keep[order]]
        if not len(order):
            return np.full(len(sign), -1), order, order, order
        new = np.append(True, (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1]))
        entry = np.full(len(sign), -1, dtype=np.int64)
        entry[order] = np.cumsum(new) - 1
        first = order[new]  # stable sorting: the first run of the smallest document
        ids = np.array([-1 if i is None else i for i in self.ids], dtype=np.int64)
        return entry, first, _classes(sign[first], self.classes), ids[doc[first]]

    def local_keys(self) -> np.ndarray:
        """Keys of signatures that stand in several documents of the batch."""
        key, doc = _key(self.all("sign"), self.classes), self.all("doc").astype(np.int64)
        ids = np.array([-1 if i is None else i for i in self.ids], dtype=np.int64)[doc] if len(doc) else doc
        order = np.lexsort((ids, key))
        k, d = key[order], ids[order]
        return np.unique(k[1:][(k[1:] == k[:-1]) & (d[1:] != d[:-1])]) if len(k) else k

    def bytes_of(self, runs: np.ndarray) -> np.ndarray:
        """Bytes of runs, one after the other."""
        bases = np.cumsum([0] + [len(r.start) for _, r in self.blocks[:-1]])
        block = np.searchsorted(bases, runs, side="right") - 1
        size = self.all("count").astype(np.int64)[runs] + LENGTH - 1
        begin = np.cumsum(size) - size
        out = np.empty(size.sum(), dtype=np.uint8)
        for k in np.unique(block):
            own = np.flatnonzero(block == k)
            r = self.blocks[k][1]
            n = size[own]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[step + np.repeat(begin[own], n)] = r.flat[step + np.repeat(r.start[runs[own] - bases[k]], n)]
        return out


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a.tobytes()) for a in arrays], dtype="<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(
        np.array([len(arrays)], dtype="<u8").tobytes() + head + b"".join(a.tobytes() for a in arrays))


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    sizes = np.frombuffer(raw, "<u8", n, 8).astype(np.int64)
    at = 8 + 8 * n + np.cumsum(sizes) - sizes
    return [np.frombuffer(raw[a:a + s], dtype=k) for a, s, k in zip(at.tolist(), sizes.tolist(), kinds)]


def _parts(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                     pa.array(columns[3], pa.binary())], names=["class", "batch", "kind", "data"])


def _signatures_of(table: pa.Table, classes: int) -> pa.Table:
    """Distinct signatures of a batch, by class, 5 bytes each; those of several runs also with
    their number of distinct runs, 2 bytes more."""
    number = table.column("batch")[0].as_py()
    batch = Batch(table, classes)
    every, content = _key(batch.all("sign"), classes), batch.all("content")
    key, times = np.unique(every, return_counts=True)
    again = np.isin(every, key[times > 1])
    every, content = every[again], content[again]
    order = np.lexsort((content, every))
    every, content = every[order], content[order]
    new = np.append(True, (every[1:] != every[:-1]) | (content[1:] != content[:-1]))[:len(every)]
    several, runs = np.unique(every[new], return_counts=True)
    several, runs = several[runs > 1], np.minimum(runs[runs > 1], 65535).astype("<u2")
    rows = [(c, number, 0, _to_five(part)) for c, part in zip(*_split(_class_of(key), key))]
    own = _class_of(several)
    for c, part, n in zip(*_split(own, several), _split(own, runs)[1]):
        rows.append((c, number, 2, _to_five(part) + n.tobytes()))
    return _parts(rows)


def _class_of(key: np.ndarray) -> np.ndarray:
    return (key >> _U(40)).astype(np.int64)


def _split(own: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """``values`` (ordered by their class ``own``) by class."""
    if not len(own):
        return [], []
    at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return own[at].tolist(), np.split(values, at[1:])


def _five(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _to_five(key: np.ndarray) -> bytes:
    return np.ascontiguousarray((key & _MASK40).view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _shared_of(table: pa.Table, hot_runs: int) -> pa.Table:
    """Signatures of a class that several batches hold, and the hot ones, back to each of those batches."""
    number = table.column("class")[0].as_py()
    held, runs = [], []
    for b, kind, data in zip(*(table.column(x).to_pylist() for x in ("batch", "kind", "data"))):
        if kind == 0:
            held.append((b, _five(data)))
        else:
            n = len(data) // 7
            runs.append((_five(data[:5 * n]), np.frombuffer(data, "<u2", n, 5 * n)))
    every, times = np.unique(np.concatenate([own for _, own in held]), return_counts=True)
    total = times.copy()
    for own, n in runs:
        total[np.searchsorted(every, own)] += n.astype(np.int64) - 1
    many, hot = every[times > 1], every[(times > 1) & (total > hot_runs)]
    rows = []
    for b, own in held:
        for kind, wanted in ((0, many), (2, hot)):
            hit = own[np.isin(own, wanted, assume_unique=True)]
            if len(hit):
                rows.append((number, b, kind, _to_five(hit)))
    return _parts(rows)


def _keys(parts: pa.Table, kind: int) -> np.ndarray:
    own = [_five(d) | (_U(c) << _U(40)) for c, k, d in zip(
        *(parts.column(x).to_pylist() for x in ("class", "kind", "data"))) if k == kind]
    return np.concatenate(own) if own else np.zeros(0, np.uint64)


def _batch_of(docs: pa.Table, parts: pa.Table, classes: int) -> tuple[Batch, np.ndarray]:
    """The batch, hot signatures split, and the keys that it shares with the classes."""
    batch = Batch(docs, classes)
    singles = batch.split(_keys(parts, 2))
    return batch, np.union1d(_keys(parts, 0), singles)


def _runs_of(docs: pa.Table, parts: pa.Table, classes: int) -> pa.Table:
    """The batch's entries of signatures shared between batches, by class, with their bytes."""
    if not docs.num_rows or not parts.num_rows:
        return _parts([])
    batch, shared = _batch_of(docs, parts, classes)
    _, first, own, smallest = batch.entries(shared)
    sign, count = batch.all("sign"), batch.all("count").astype(np.int64)
    rows = []
    for c, runs, least in zip(*_split(own, first), _split(own, smallest)[1]):
        rows.append((c, docs.column("batch")[0].as_py(), 1, _pack(
            sign[runs].astype("<u8"), count[runs].astype(np.uint8), least.astype("<i8"), batch.bytes_of(runs))))
    return _parts(rows)


def _ordered_of(table: pa.Table) -> pa.Table:
    """Bits of the suffixes of a class whose head a smaller document has, back to the batches."""
    number = table.column("class")[0].as_py()
    batches = table.column("batch").to_pylist()
    sent = [_unpack(d, "<u8", "u1", "<i8", "u1") for d in table.column("data").to_pylist()]
    sign, count, smallest, data = (np.concatenate([s[i] for s in sent]) for i in range(4))
    count = count.astype(np.int64)
    size = count + LENGTH - 1
    begin = np.cumsum(size) - size
    content = np.concatenate([_content(s[1], s[3]) for s in sent])
    # equal runs of several batches are one; its smallest document counts
    order = np.lexsort((smallest, content, sign))
    new = np.append(True, (sign[order][1:] != sign[order][:-1]) | (content[order][1:] != content[order][:-1]))
    run = np.empty(len(order), dtype=np.int64)
    run[order] = np.cumsum(new) - 1
    rep = order[new]
    least = smallest[rep]
    # suffixes of signatures with more than one content need ordering
    group_new = np.append(True, sign[rep][1:] != sign[rep][:-1])
    group = np.cumsum(group_new) - 1
    contents = np.bincount(group)
    mixed = np.flatnonzero(contents[group] > 1)
    _log.info("class %d: %d runs, largest group %d contents", number, len(order), contents.max(initial=0))
    total = np.cumsum(count[rep]) - count[rep]
    best = np.repeat(least, count[rep])
    for part in _portions(mixed, group[mixed], count[rep]):
        n = count[rep][part]
        suffix = np.repeat(begin[rep][part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        heads = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[suffix]
        by, cls = order_heads(heads)
        owner = np.repeat(least[part], n)
        first = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
        low = np.minimum.reduceat(owner[by], first)
        found = np.empty(len(by), dtype=np.int64)
        found[by] = low[cls]
        best[np.repeat(total[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = found
    rows, at = [], 0
    for b, s in zip(batches, sent):
        own = np.arange(at, at + len(s[0]))
        at += len(s[0])
        n = count[own]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = best[np.repeat(total[run[own]], n) + step] < np.repeat(smallest[own], n)
        bits = np.bitwise_or.reduceat(hit.astype(np.uint64) << step.astype(np.uint64), np.cumsum(n) - n)
        rows.append((number, b, 1, _pack(bits.astype("<u4"))))
    return _parts(rows)


def _content(count: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Codes of the bytes of each run."""
    size = count.astype(np.int64) + LENGTH - 1
    begin = np.cumsum(size) - size
    return textcodes.range_codes(textcodes.prefix_codes(data), begin, begin + size)


def _portions(runs: np.ndarray, group: np.ndarray, count: np.ndarray, limit: int = 1 << 19):
    """Runs of whole groups, about ``limit`` suffixes together (a larger group is one portion)."""
    if not len(runs):
        return
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.add.reduceat(count[runs], edge)
    portion = (np.cumsum(size) - size) // limit
    cut = edge[np.flatnonzero(np.append(True, portion[1:] != portion[:-1]))]
    yield from np.split(runs, cut[1:])


def _removed_of(docs: pa.Table, parts: pa.Table, classes: int) -> pa.Table:
    """Result rows of a batch."""
    if not docs.num_rows:
        return pa.table([[]] * 5, schema=_RESULT)
    batch, shared = _batch_of(docs, parts, classes)
    bits = {c: _unpack(d, "<u4")[0] for c, k, d in zip(
        *(parts.column(x).to_pylist() for x in ("class", "kind", "data"))) if k == 1}
    # entries of both kinds: shared between batches, and between documents of this batch
    entry, first, own, _ = batch.entries(shared)
    flags = np.concatenate([bits[c] for c, _ in zip(*_split(own, own))]) if len(first) else np.zeros(0, "<u4")
    mask = np.where(entry >= 0, flags[np.maximum(entry, 0)] if len(flags) else 0, 0).astype(np.uint64)
    mask |= _local_mask(batch)
    step = np.arange(RUN, dtype=np.uint64)
    out, at = [], 0
    for base, runs in batch.blocks:
        n = len(runs.start)
        hit = ((mask[at:at + n, None] >> step[None, :]) & _U(1)).astype(bool)
        hit &= step[None, :] < runs.count[:, None].astype(np.uint64)
        at += n
        begin = (runs.start[:, None] + step[None, :].astype(np.int64))[hit]
        edge = np.zeros(len(runs.flat) + LENGTH + 1, dtype=np.int32)
        edge[begin] += 1  # each suffix is in one run
        edge[begin + LENGTH] -= 1
        gone = np.cumsum(edge)[:len(runs.flat)] > 0
        ends = np.append(runs.first[1:], len(runs.flat))
        for i, (a, b) in enumerate(zip(runs.first.tolist(), ends.tolist())):
            text, cut = batch.texts[base + i], gone[a:b]
            if batch.ids[base + i] is None:
                cut = np.zeros(len(text), dtype=bool)
            kept = np.frombuffer(text, np.uint8)[~cut].tobytes() if cut.any() else text
            spans = int(cut[:1].sum()) + int((cut[1:] & ~cut[:-1]).sum())
            out.append((batch.ids[base + i], len(text), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string())])


def _local_mask(batch: Batch) -> np.ndarray:
    """Bits of the suffixes whose head a smaller document of the same batch has."""
    sign = batch.all("sign")
    mask = np.zeros(len(sign), dtype=np.uint64)
    keys = batch.local_keys()
    if not len(keys):
        return mask
    entry, first, _, smallest = batch.entries(keys)
    ids = np.array([-1 if i is None else i for i in batch.ids], dtype=np.int64)
    count, doc = batch.all("count").astype(np.int64), batch.all("doc").astype(np.int64)
    # heads of different contents of one signature, ordered inside the batch
    table = pa.table([pa.array([0], pa.int32()), pa.array([0], pa.int32()), pa.array([1], pa.int32()), pa.array([_pack(
        sign[first].astype("<u8"), count[first].astype(np.uint8), smallest.astype("<i8"), batch.bytes_of(first))], pa.binary())],
        names=["class", "batch", "kind", "data"])
    bits = _unpack(_ordered_of(table).column("data")[0].as_py(), "<u4")[0].astype(np.uint64)
    run = np.flatnonzero(entry >= 0)
    own = entry[run]
    later = ids[doc[run]] > smallest[own]
    whole = (_U(1) << count[run].astype(np.uint64)) - _U(1)
    mask[run] = np.where(later, whole, bits[own])
    return mask


def repeated_strings(docs: DataFrame, batch_docs: int = BATCH_DOCS, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Bytes, removed bytes and spans, and the digest of the rest of each document (``SCHEMA``)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    batches = max(1, -(-n // batch_docs))
    classes = max(ordered.shuffle_partitions(docs), -(-size // CLASS_BYTES))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(batches)).cast("int"))
    signs = dealt.groupBy("batch").applyInArrow(lambda t: _signatures_of(t, classes), PARTS)
    shared = signs.groupBy("class").applyInArrow(lambda t: _shared_of(t, hot_runs), PARTS)
    runs = dealt.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(
        lambda d, p: _runs_of(d, p, classes), PARTS)
    found = runs.groupBy("class").applyInArrow(_ordered_of, PARTS)
    return dealt.groupBy("batch").cogroup(shared.unionByName(found).groupBy("batch")).applyInArrow(
        lambda d, p: _removed_of(d, p, classes), SCHEMA)
