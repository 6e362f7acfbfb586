"""Acyclic automata with counts over sequences of words, in numpy.

An automaton holds sequences of one length; a path from its root spells one and the last
arc carries its count.  It is built from sorted sequences in blocks: the states of a block
are closed once its first words are over, from the last word backwards, and a state with the
arcs of an earlier one (the register) is that state.  Automata are united by summing the counts of
equal paths, and one is composed with another to look up its paths there.

Words are bytes; an automaton numbers its own words in byte order, so arcs sorted by
label spell the sequences in order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from .textcodes import mix

BLOCK_ROWS = 1 << 16
_U = np.uint64
_KINDS = ["u1", "<u2", "<i4", "<i8"]


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in the smallest kind that holds them."""
    top = int(values.max(initial=0))
    return values.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<i4" if top < 1 << 31 else "<i8")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of bytes and integers as one compressed value."""
    head = [len(arrays)]
    for a in arrays:
        head += [_KINDS.index(a.dtype.str.replace("|", "")), a.nbytes]
    raw = np.array(head, "<i8").tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8).tolist()
    out, at = [], 8 * (1 + 2 * n)
    for kind, size in zip(head[::2], head[1::2]):
        dtype = np.dtype(_KINDS[kind])
        out.append(np.frombuffer(raw, dtype, size // dtype.itemsize, at))
        at += size
    return out


def word_arrays(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and joined bytes of an array of words."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype("<i4")
    joined = b"".join(words.to_pylist())
    return lengths, np.frombuffer(joined, np.uint8)


def words_of(lengths: np.ndarray, joined: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(joined))])


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows, and for each row the number of its equal."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    code = np.zeros(len(rows), np.int64)
    for d in range(rows.shape[1]):
        _, index, code = np.unique((code << 32) | rows[:, d].astype(np.int64), return_index=True, return_inverse=True)
    return rows[index], code


class Automaton:
    """Sequences of ``depth`` words with counts; state 0 is the end, ``root`` the start.

    Arcs are sorted by state and label: ``source, label, target, count``."""

    def __init__(self, words: pa.Array, depth: int, root: int, arcs: np.ndarray, counts: np.ndarray):
        self.words, self.depth, self.root = words, depth, root
        self.source, self.label, self.target = arcs
        self.counts = counts

    @classmethod
    def build(cls, words: pa.Array, rows: np.ndarray, counts: np.ndarray) -> "Automaton":
        """From sorted distinct rows of word numbers.  Only the words that occur are kept."""
        seen = np.zeros(len(words), bool)
        seen[rows] = True
        rows = (np.cumsum(seen) - 1)[rows]
        if not seen.all():
            words = words.take(pa.array(np.flatnonzero(seen)))
        depth = rows.shape[1]
        register: dict[tuple[int, int], int] = {}
        parts: list[np.ndarray] = []
        weights: list[np.ndarray] = []
        states = 1

        def close(parent: np.ndarray, label: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
            """State of each run of equal ``parent``: registered, or new with these arcs."""
            nonlocal states
            first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            arc = mix(label.astype(_U) * _U(0x9E3779B97F4A7C15) + mix(target.astype(_U) + mix(weight.astype(_U))))
            one, two = np.add.reduceat(arc, first), np.add.reduceat(mix(arc ^ _U(0x5851F42D4C957F2D)), first)
            # equal states of this call by their signature, then those closed before
            _, head, group = np.unique(one, return_index=True, return_inverse=True)
            if (two[head][group] != two).any():
                raise ValueError("two states of one signature")
            known = np.empty(len(head), np.int64)
            fresh = np.zeros(len(first), bool)
            for i, (at, signature) in enumerate(zip(head.tolist(), zip(one[head].tolist(), two[head].tolist()))) if len(cuts) > 1 else ():
                known[i] = register.get(signature, -1)
                if known[i] < 0:
                    known[i] = register[signature] = states
                    states += 1
                    fresh[at] = True
            if len(cuts) == 1:
                known[:] = np.arange(states, states + len(head))
                states += len(head)
                fresh[head] = True
            out = known[group]
            run = np.cumsum(np.append(True, parent[1:] != parent[:-1])) - 1
            keep = fresh[run]
            parts.append(np.stack([out[run][keep], label[keep], target[keep]]))
            weights.append(weight[keep])
            return out

        heads = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if depth < 3 else \
            np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
        open_depth = min(depth - 1, 2 if depth >= 3 else 1)
        held: list[tuple[np.ndarray, ...]] = []  # arcs into the closed states: path so far, target, weight
        cuts = [0]
        for h in heads.tolist():
            if h - cuts[-1] >= BLOCK_ROWS:
                cuts.append(h)
        for a, b in zip(cuts, [*cuts[1:], len(rows)]):
            if a == b:
                continue
            path, target, weight = rows[a:b], np.zeros(b - a, np.int64), counts[a:b].astype(np.int64)
            for d in range(depth - 1, open_depth - 1, -1):
                new = np.append(True, (path[1:, :d] != path[:-1, :d]).any(axis=1))
                target = close(np.cumsum(new), path[:, d], target, weight)
                path, weight = path[new], np.zeros(int(new.sum()), np.int64)
            held.append((path[:, :open_depth], target, weight))
        if held:
            path, target, weight = (np.concatenate(x) for x in zip(*held))
            for d in range(open_depth - 1, -1, -1):
                new = np.append(True, (path[1:, :d] != path[:-1, :d]).any(axis=1)) if d else np.arange(len(path)) == 0
                target = close(np.cumsum(new), path[:, d], target, weight)
                path, weight = path[new], np.zeros(int(new.sum()), np.int64)
        root = int(target[0]) if held else 0
        arcs = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int64)
        total = np.concatenate(weights) if weights else np.zeros(0, np.int64)
        order = np.lexsort((arcs[1], arcs[0]))
        return cls(words, depth, root, arcs[:, order], total[order])

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences in order as rows of word numbers, and their counts."""
        first = np.searchsorted(self.source, np.arange(int(self.source.max(initial=0)) + 2))
        state = np.array([self.root] if len(self.source) else [], np.int64)
        rows, count = np.zeros((len(state), 0), np.int64), np.zeros(0, np.int64)
        for _ in range(self.depth):
            size = first[state + 1] - first[state]
            arc = np.repeat(first[state] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            rows = np.column_stack([np.repeat(rows, size, axis=0), self.label[arc]])
            state, count = self.target[arc], self.counts[arc]
        return rows.reshape(-1, self.depth), count

    def look_up(self, words: pa.Array, rows: np.ndarray) -> np.ndarray:
        """Counts of rows over other ``words``; 0 for those that are not paths here."""
        if not len(self.source) or not len(rows):
            return np.zeros(len(rows), np.int64)
        here = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        codes = (self.source << 32) | self.label
        state, count = np.full(len(rows), self.root, np.int64), np.zeros(len(rows), np.int64)
        alive = np.arange(len(rows))
        for d in range(self.depth):
            label = here[rows[alive, d]]
            alive, label = alive[label >= 0], label[label >= 0]
            asked = (state[alive] << 32) | label
            at = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
            hit = codes[at] == asked
            alive, at = alive[hit], at[hit]
            state[alive] = self.target[at]
        count[alive] = self.counts[at] if len(alive) else 0
        return count

    def compose(self, asked: "Automaton") -> np.ndarray:
        """Counts here of the sequences of ``asked``, in its order."""
        return self.look_up(asked.words, asked.paths()[0])

    def to_bytes(self) -> bytes:
        lengths, joined = word_arrays(self.words)
        arcs = np.bincount(self.source, minlength=1)  # arcs of each state, from 0 on
        return pack(np.array([self.depth, self.root], "<i8"), narrow(lengths), joined, narrow(arcs), narrow(self.label),
                    narrow(self.target), narrow(self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> "Automaton":
        (depth, root), lengths, joined, arcs, label, target, counts = unpack(data)
        source = np.repeat(np.arange(len(arcs)), arcs.astype(np.int64))
        return cls(words_of(lengths, joined), int(depth), int(root),
                   np.stack([source, label.astype(np.int64), target.astype(np.int64)]), counts.astype(np.int64))


def united(automata: Sequence[Automaton], least: int = 1) -> Automaton:
    """Union of automata of one depth with summed counts; sequences counted under ``least`` times are left out."""
    words = pc.unique(pa.concat_arrays([a.words for a in automata]))
    words = words.take(pc.sort_indices(words))
    rows, counts = [], []
    for a in automata:
        own, n = a.paths()
        here = pc.index_in(a.words, value_set=words).to_numpy().astype(np.int64)
        rows.append(here[own])
        counts.append(n)
    found, number = distinct(np.concatenate(rows))
    total = np.zeros(len(found), np.int64)
    np.add.at(total, number, np.concatenate(counts))
    enough = total >= least
    return Automaton.build(words, found[enough], total[enough])
