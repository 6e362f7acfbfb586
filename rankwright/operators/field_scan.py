"""Passes over the texts of a field index: what a task does with its documents (Arrow and numpy).

A task takes its documents in chunks of ``CHUNK_BYTES`` of text and the pairs of documents and queries in slices of
``SLICE`` pairs, so its memory does not grow with the corpus.  Texts arrive as tokens joined by spaces; a set of
queries arrives as a :class:`Block`, sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PLAIN = "_plain"
# Fields that have no plain variant, and their analyzers.
SPECIAL = {"suggest": "stem", "all_near_match": "keyword"}
STEM_SUFFIXES = ("ing", "es", "s")
CHUNK_BYTES = 4 << 20
SLICE = 1 << 17


def analyzer_of(name: str) -> str:
    return SPECIAL.get(name, "plain" if name.endswith(PLAIN) else "stem")


def stemmed(words: pa.Array) -> pa.Array:
    """Words without the first of ``STEM_SUFFIXES`` that they end with (of more than 4 characters)."""
    out, long = words, pc.greater(pc.utf8_length(words), 4)
    for suffix in reversed(STEM_SUFFIXES):
        out = pc.if_else(pc.and_(long, pc.ends_with(words, suffix)), pc.utf8_slice_codeunits(words, 0, -len(suffix)), out)
    return out


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of ``values`` (null has one too) and the value of each code."""
    found = pc.dictionary_encode(values, null_encoding="encode")
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def places(values: pa.Array, of: pa.Array) -> np.ndarray:
    """Where each value stands in ``of``; -1 for none and for null."""
    return pc.fill_null(pc.index_in(values, value_set=of, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``keys`` in order, and how often each occurs."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.concatenate([at, [len(keys)]]))


def spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges ``lo`` to ``hi`` one after another, each with its range."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) + np.repeat(lo - (np.cumsum(n) - n), n)


def least(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def slices(load: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``SLICE`` pairs; ``load``: the pairs of each."""
    total, at = np.cumsum(load), 0
    while at < len(load):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, "right")))
        yield at, end
        at = end


@dataclass(frozen=True)
class Texts:
    """The text columns that ``fields`` are made of; a field in ``joined`` is its parts, one after another."""
    fields: tuple[str, ...]
    joined: Mapping[str, tuple[str, ...]]

    def parts(self, base: str) -> tuple[str, ...]:
        return self.joined.get(base, (base,))

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(p for name in self.fields for p in self.parts(name.removesuffix(PLAIN))))


def chunks(batches, columns: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of about ``CHUNK_BYTES`` of text.  Neighbours of one ``doc_id`` are not parted."""
    held, size = [], 0
    for batch in batches:
        while batch.num_rows:
            total = size + np.cumsum(sum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns))
            last = int(np.searchsorted(total, CHUNK_BYTES))
            doc = codes(batch.column("doc_id"))[0] if last < batch.num_rows else None
            others = np.flatnonzero(doc[last:] != doc[last]) if doc is not None else ()
            if not len(others):
                held, size = [*held, batch], int(total[-1])
                break
            end = last + int(others[0])
            yield pa.Table.from_batches([*held, batch.slice(0, end)]).combine_chunks()
            held, size, batch = [], 0, batch.slice(end)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Chunk:
    """The tokens of some documents.  Rows of one language and id are one document; of these, rows of one length in a field
    are taken together."""

    def __init__(self, rows: pa.Table, texts: Texts):
        self.rows, self.texts, n = rows, texts, rows.num_rows
        lang, self.langs = codes(rows["lang"].chunk(0))
        doc, ids = codes(rows["doc_id"].chunk(0))
        found, first, of = np.unique(lang * len(ids) + doc, return_index=True, return_inverse=True)
        self.repeated = len(found) < n
        self.of, self.first = (of.reshape(-1), first) if self.repeated else (np.arange(n), np.arange(n))
        self.row_lang, self.lang = lang, lang[self.first]
        self.nameless = np.asarray(pc.or_(pc.is_null(rows["lang"]), pc.is_null(rows["doc_id"])))[self.first]
        self.sizes, parts = {}, []
        for c in texts.columns:
            lists = pc.split_pattern(rows[c].chunk(0), " ")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            words, empty = lists.flatten(), pc.equal(rows[c].chunk(0), "")
            if pc.any(empty).as_py():
                sizes[np.asarray(empty)] = 0
                words = words.filter(pc.not_equal(words, ""))
            self.sizes[c] = sizes
            parts.append(words)
        flat, self.words = codes(pa.concat_arrays(parts))
        self.codes = dict(zip(texts.columns, np.split(flat, np.cumsum([len(p) for p in parts])[:-1])))
        self.stems, self._numbers = None, {}

    def _base(self, base: str) -> tuple[np.ndarray, np.ndarray]:
        parts = self.texts.parts(base)
        if len(parts) > 1 and base not in self.codes:
            sizes = sum(self.sizes[p] for p in parts)
            at, out = starts_of(sizes), np.empty(int(sizes.sum()), np.int64)
            for p in parts:
                out[spans(at, at + self.sizes[p])[1]] = self.codes[p]
                at = at + self.sizes[p]
            self.codes[base], self.sizes[base] = out, sizes
        base = base if len(parts) > 1 else parts[0]
        return self.codes[base], self.sizes[base]

    def tokens(self, name: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The terms of a field row by row (codes), how many each row has, and the words of the codes."""
        base, analyzer = name.removesuffix(PLAIN), analyzer_of(name)
        if analyzer == "keyword":
            parts = [self.rows[p].chunk(0) for p in self.texts.parts(base)]
            if len(parts) > 1:
                parts = [pc.if_else(pc.equal(p, ""), pa.scalar(None, pa.string()), p) for p in parts]
                parts = [pc.binary_join_element_wise(*parts, " ", null_handling="skip")]
            some = pc.not_equal(parts[0], "")
            found, words = codes(parts[0].filter(some))
            return found, np.asarray(some).astype(np.int64), words
        found, sizes = self._base(base)
        if analyzer == "plain":
            return found, sizes, self.words
        if self.stems is None:
            self.stems = codes(stemmed(self.words))
        return self.stems[0][found], sizes, self.stems[1]

    def numbers(self, name: str, vocab: Mapping[str, pa.Array]) -> np.ndarray:
        """The number in ``vocab`` (by analyzer) of each word of the field's codes, or -1."""
        key = name if analyzer_of(name) == "keyword" else analyzer_of(name)
        if key not in self._numbers:
            self._numbers[key] = places(self.tokens(name)[2], vocab[analyzer_of(name)])
        return self._numbers[key]

    def variants(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row what it is counted with; the document and length of these, by document."""
        if not self.repeated:
            return np.arange(len(sizes)), self.of, sizes
        found, first, of = np.unique(self.of * (int(sizes.max(initial=0)) + 1) + sizes, return_index=True, return_inverse=True)
        return of.reshape(-1), self.of[first], sizes[first]

    def postings(self, name: str, ids: np.ndarray | None = None, width: int = 0):
        """(document, term, tf, length), by document; terms are codes, or what ``ids`` has for them (below ``width``; -1: not
        asked)."""
        terms, sizes, words = self.tokens(name)
        of, docs, lengths = self.variants(sizes)
        of = np.repeat(of, sizes)
        if ids is None:
            width = len(words)
        else:
            terms = ids[terms]
            of, terms = of[terms >= 0], terms[terms >= 0]
        key, tf = counted(of * max(width, 1) + terms)
        of = key // max(width, 1)
        return docs[of], key % max(width, 1), tf, lengths[of]

    def doc_ids(self, docs: np.ndarray) -> pa.Array:
        return self.rows["doc_id"].chunk(0).take(pa.array(self.first[docs]))

    def doc_langs(self, docs: np.ndarray) -> pa.Array:
        return self.langs.take(pa.array(self.lang[docs]))


def task_counts(texts: Texts, asked, batches):
    """(lang, field, term, df, ttf) of a task's documents, for the terms that are asked for or all; with the term null the
    rows that have the field and their length."""
    for rows in chunks(batches, texts.columns):
        chunk = Chunk(rows, texts)
        for name in texts.fields:
            _, sizes, words = chunk.tokens(name)
            ids = None
            if asked is not None:
                ids = chunk.numbers(name, asked.value)
                ids = np.where(ids >= 0, np.arange(len(words)), -1)
            docs, terms, tf, _ = chunk.postings(name, ids, len(words))
            key, n = chunk.lang[docs] * max(len(words), 1) + terms, len(chunk.langs)
            df, ttf = np.bincount(key), np.bincount(key, weights=tf)
            held = np.flatnonzero(df)
            lang = np.flatnonzero(np.bincount(chunk.row_lang[sizes > 0], minlength=n))
            has = np.bincount(chunk.row_lang[sizes > 0], minlength=n)[lang]
            long = np.bincount(chunk.row_lang, weights=sizes, minlength=n)[lang]
            yield pa.RecordBatch.from_arrays([
                chunk.langs.take(pa.array(np.concatenate([held // max(len(words), 1), lang]))), pa.array([name] * (len(held) + len(lang)), pa.string()),
                pa.concat_arrays([words.take(pa.array(held % max(len(words), 1))), pa.nulls(len(lang), pa.string())]),
                pa.array(np.concatenate([df[held], has]), pa.int64()), pa.array(np.concatenate([ttf[held], long]).astype(np.int64))],
                ["lang", "field", "term", "df", "ttf"])


def task_postings(texts: Texts, phrase_fields: frozenset, batches):
    """(lang, doc_id, field, term, dl, tf, positions) of a task's documents; positions of ``phrase_fields`` only."""
    for rows in chunks(batches, texts.columns):
        chunk = Chunk(rows, texts)
        for name in texts.fields:
            terms, sizes, words = chunk.tokens(name)
            docs, held, tf, dl = chunk.postings(name)
            if not len(held):
                continue
            if name in phrase_fields:
                at = np.arange(len(terms)) - np.repeat(starts_of(sizes), sizes)
                order = np.lexsort((at, np.repeat(chunk.variants(sizes)[0], sizes) * len(words) + terms))
                offsets, at = np.concatenate([[0], np.cumsum(tf)]), at[order]
            else:
                offsets, at = np.zeros(len(held) + 1), np.zeros(0)
            found = pa.table([chunk.doc_langs(docs), chunk.doc_ids(docs), pa.array([name]).take(pa.array(np.zeros(len(held), np.int64))), words.take(pa.array(held)),
                              pa.array(dl, pa.int32()), pa.array(tf, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(at, pa.int32()))],
                             ["lang", "doc_id", "field", "term", "dl", "tf", "positions"])
            yield from found.to_batches(max_chunksize=1 << 16)


# ---------------------------------------------------------------- queries
@dataclass
class Block:
    """A set of queries by number, with their terms under each analyzer (numbers in ``vocab``, which is in order) and, after
    :meth:`learn`, the statistics of these terms.

    ``rows``: (ends, term, number of terms of its text) of each query's distinct terms; ``order``: (ends, term, place)."""
    items: pa.Array
    vocab: dict = field(default_factory=dict)
    rows: dict = field(default_factory=dict)
    order: dict = field(default_factory=dict)
    langs: pa.Array = None
    stats: dict = field(default_factory=dict)
    docs: dict = field(default_factory=dict)
    seeds: dict = field(default_factory=dict)
    k1: float = 1.2
    b: float = 0.75

    @staticmethod
    def of(table: pa.Table, k1: float, b: float) -> "Block":
        """From (item_id, words): the tokens of each text, joined by spaces.  An id may have several texts."""
        item, items = codes(whole(table["item_id"]))
        order = np.argsort(item, kind="stable")
        item, texts = item[order], whole(table["words"]).take(pa.array(order))
        block, n = Block(items, k1=k1, b=b), len(items)
        lists = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        plain, plain_words = codes(lists.flatten())
        del lists
        for analyzer in ("plain", "stem", "keyword"):
            term, words = (plain, plain_words) if analyzer == "plain" else codes(stemmed(plain_words) if analyzer == "stem" else texts)
            size = sizes if analyzer != "keyword" else np.ones(len(texts), np.int64)
            by = pc.sort_indices(words.cast(pa.binary())).to_numpy()
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            block.vocab[analyzer] = words.take(pa.array(by))
            term = rank[term[plain] if analyzer == "stem" else term]
            text = np.repeat(np.arange(len(size)), size)
            block.order[analyzer] = (_ends(item[text], n), least(term), least(np.arange(len(term)) - np.repeat(starts_of(size), size)))
            held = counted(text * max(len(by), 1) + term)[0]
            del text
            own, term = held // max(len(by), 1), least(held % max(len(by), 1))
            del held
            block.rows[analyzer] = (_ends(item[own], n), term, least(np.bincount(own, minlength=len(size)))[own])
        return block

    def only(self, order: bool, ttf: bool) -> "Block":
        """What a pass needs: with the places of terms, with ``ttf``."""
        return replace(self, order=self.order if order else {}, stats=self.stats if ttf else {f: (key, df, None) for f, (key, df, _) in self.stats.items()})

    def learn(self, fields: Sequence[str], known) -> None:
        """From (lang, term, df, ttf) of each field (``known``: by name), where the term null has the documents of the field and
        their length."""
        for name in fields:
            table = known(name)
            width = len(self.vocab[analyzer_of(name)])
            lang, terms = places(whole(table["lang"]), self.langs), places(whole(table["term"]), self.vocab[analyzer_of(name)])
            df, ttf = whole(table["df"]).to_numpy(), whole(table["ttf"]).to_numpy()
            total = np.flatnonzero((lang >= 0) & np.asarray(pc.is_null(whole(table["term"])), bool))
            n_docs, length = np.zeros(len(self.langs)), np.zeros(len(self.langs))
            n_docs[lang[total]], length[lang[total]] = df[total], ttf[total]
            self.docs[name] = (n_docs, length / np.maximum(n_docs, 1))
            own = np.flatnonzero((lang >= 0) & (terms >= 0))
            key = lang[own] * width + terms[own]
            order = np.argsort(key)
            self.stats[name] = (least(key[order]), least(df[own][order]), least(ttf[own][order]))

    def seek(self, names: Sequence[str]) -> None:
        """The rarest term, by language, of each query whose every term the language has: (key, ends, query, number of terms)."""
        for name in names:
            if name in self.seeds:
                continue
            ends, term, n_terms = self.rows[analyzer_of(name)]
            width, query = len(self.vocab[analyzer_of(name)]), np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            keys, df, _ = self.stats[name]
            found = []
            for lang in range(len(self.langs)):
                lo, hi = (int(np.searchsorted(keys, _as(x, keys))) if x <= int(keys.max(initial=0)) else len(keys) for x in (lang * width, (lang + 1) * width))
                own = np.zeros(width, np.int64)
                own[keys[lo:hi].astype(np.int64) - lang * width] = df[lo:hi]
                row = np.flatnonzero(own[term])
                most = np.zeros(len(ends) - 1, np.int64)
                np.maximum.at(most, query[row], n_terms[row])
                row = row[(np.bincount(query[row], minlength=len(most)) == most)[query[row]]]
                row = row[np.lexsort((term[row], own[term[row]], query[row]))]
                row = row[np.concatenate([[True], query[row][1:] != query[row][:-1]])] if len(row) else row
                found.append((lang * width + term[row].astype(np.int64), query[row], most[query[row]]))
            key, query, most = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
            order = np.argsort(key, kind="stable")
            held, n = counted(key)
            self.seeds[name] = (held, np.concatenate([[0], np.cumsum(n)]), least(query[order]), least(most[order]))


def _as(x, keys: np.ndarray):
    """In the type of ``keys``, which are searched as they are then."""
    return np.asarray(x).astype(keys.dtype)


def rank_in(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each number (from 0) stands in ``keys`` (in order), or -1."""
    if not len(keys):
        return np.full(len(asked), -1)
    at = np.searchsorted(keys, _as(np.minimum(asked, int(keys[-1])), keys))
    return np.where(keys[at] == asked, at, -1)


def _ends(of: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])


class Matches:
    """Queries of a block and documents of a chunk; pairs are (document, query) arrays."""

    def __init__(self, chunk: Chunk, block: Block):
        self.chunk, self.block = chunk, block
        self.lang = places(chunk.langs, block.langs)[chunk.lang]
        self.lang[chunk.nameless] = -1
        self._held, self._seed, self._order, self._names = {}, {}, {}, None

    def ids(self, name: str) -> np.ndarray:
        return self.chunk.numbers(name, self.block.vocab)

    def width(self, name: str) -> int:
        return max(len(self.block.vocab[analyzer_of(name)]), 1)

    def postings(self, name: str):
        """(key, tf, length) of the postings of the queries' terms, by key: document and term."""
        if name not in self._held:
            docs, terms, tf, dl = self.chunk.postings(name, self.ids(name), self.width(name))
            key = docs * self.width(name) + terms
            if self.chunk.repeated:
                order = np.argsort(key, kind="stable")
                key, tf, dl = key[order], tf[order], dl[order]
            self._held[name] = (key, tf, dl)
        return self._held[name]

    def find(self, name: str, docs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of postings of each document and term."""
        key = self.postings(name)[0]
        asked = docs * self.width(name) + terms
        lo = np.searchsorted(key, asked)
        if self.chunk.repeated:
            return lo, np.searchsorted(key, asked, "right")
        return lo, lo + (key[np.minimum(lo, len(key) - 1)] == asked if len(key) else 0)

    def seeded(self, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first, end) in the seeds of the postings that are the rarest term of a query."""
        if name not in self._seed:
            key, (seeds, ends, *_) = self.postings(name)[0], self.block.seeds[name]
            docs = key // self.width(name)
            asked = self.lang[docs] * self.width(name) + key % self.width(name)
            at = np.minimum(np.searchsorted(seeds, asked), max(len(seeds) - 1, 0))
            hit = np.flatnonzero((self.lang[docs] >= 0) & (seeds[at] == asked)) if len(seeds) else np.zeros(0, np.int64)
            self._seed[name] = (docs[hit], ends[at[hit]], ends[at[hit] + 1])
        return self._seed[name]

    def holders(self, name: str, a: int, z: int):
        """Documents ``a`` to ``z`` that hold the rarest term of a query: (document, query, how many postings, number of terms)."""
        docs, lo, hi = self.seeded(name)
        i, j = np.searchsorted(docs, [a, z])
        which, at = spans(lo[i:j], hi[i:j])
        docs, query, n = docs[i:j][which], self.block.seeds[name][2][at].astype(np.int64), self.block.seeds[name][3][at]
        if not self.chunk.repeated:
            return docs, query, np.ones(len(docs), np.int64), n
        _, first, many = np.unique(docs * len(self.block.items) + query, return_index=True, return_counts=True)
        return docs[first], query[first], many, n[first]

    def complete(self, name: str, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of documents ``a`` to ``z`` and the queries whose every term they hold in the field."""
        docs, query, near, n = self.holders(name, a, z)
        ends, terms, _ = self.block.rows[analyzer_of(name)]
        which, at = spans(ends[query], ends[query + 1])
        lo, hi = self.find(name, docs[which], terms[at])
        held = (near * np.bincount(which, weights=hi - lo, minlength=len(docs)) == n) & self.named_query(query)
        return docs[held], query[held]

    def named_query(self, query: np.ndarray) -> np.ndarray:
        return np.asarray(pc.is_valid(self.block.items))[query]

    def near(self, name: str, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of documents ``a`` to ``z`` and the queries that share a term of the field."""
        if self._names is None:
            ends, terms, _ = self.block.rows[analyzer_of(name)]
            order = np.argsort(terms, kind="stable")
            query = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[order]
            held = self.postings(name)[0]
            lo, hi = (np.searchsorted(terms[order], _as(held % self.width(name), terms), side) for side in ("left", "right"))
            self._names = (held // self.width(name), lo, hi, query)
        docs, lo, hi, query = self._names
        i, j = np.searchsorted(docs, [a, z])
        which, at = spans(lo[i:j], hi[i:j])
        return pairs_of(docs[i:j][which], query[at], len(self.block.items))

    def load(self, required: Sequence[str], near: str | None = None) -> np.ndarray:
        """About how many pairs each document will have."""
        n = np.zeros(len(self.chunk.first), np.int64)
        for name in required:
            docs, lo, hi = self.seeded(name)
            n += np.bincount(docs, weights=hi - lo, minlength=len(n)).astype(np.int64)
        if near is not None:
            self.near(near, 0, 0)
            docs, lo, hi, _ = self._names
            n += np.bincount(docs, weights=hi - lo, minlength=len(n)).astype(np.int64)
        return n

    def scores(self, name: str, docs: np.ndarray, query: np.ndarray, whole: bool = True):
        """BM25 of the pairs in a field, the postings that met and the number of terms; 0 postings: no score."""
        ends, terms, n_terms = self.block.rows[analyzer_of(name)]
        which, at = spans(ends[query], ends[query + 1])
        real = (self.lang[docs[which]] >= 0) & self.named_query(query[which])
        which, at = which[real], at[real]
        lo, hi = self.find(name, docs[which], terms[at])
        row, held = spans(lo, hi)
        which, at = which[row], at[row]
        _, tf, dl = self.postings(name)
        key, df, _ = self.block.stats[name]
        lang = self.lang[docs[which]]
        df = df[rank_in(key, lang * self.width(name) + terms[at])].astype(float)
        n_docs, avg_dl = (x[lang] for x in self.block.docs[name])
        k1, b = self.block.k1, self.block.b
        tf = tf[held].astype(float)
        part = np.log(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[held] / avg_dl))
        score = np.bincount(which, weights=part, minlength=len(docs))
        if not whole:
            return score
        most = np.zeros(len(docs), np.int64)
        np.maximum.at(most, which, n_terms[at])
        return score, np.bincount(which, minlength=len(docs)), most

    def phrases(self, name: str, docs: np.ndarray, query: np.ndarray, many: np.ndarray | None = None) -> np.ndarray:
        """How often the field holds the query as a phrase (occurrences that do not overlap, from the left).

        A phrase starts where every term stands at its distance.  Its rarest term in the document is looked up; the others
        are compared where they should stand.  Where rows share an id, or a pair has several holders, all places of
        all terms are counted instead (``many``: how often)."""
        ends, terms, place = self.block.order[analyzer_of(name)]
        real = (self.lang[docs] >= 0) & self.named_query(query) & (ends[query] < ends[query + 1])
        out, chosen = np.zeros(len(docs), np.int64), np.flatnonzero(real)
        docs, query = docs[chosen], query[chosen]
        size = ends[query + 1] - ends[query]
        if name not in self._order:
            tokens, sizes, _ = self.chunk.tokens(name)
            self._order[name] = (self.ids(name)[tokens] if len(tokens) else np.zeros(0, np.int64), sizes, starts_of(sizes), np.repeat(np.arange(len(sizes)), sizes))
        ids, sizes, begin, row = self._order[name]
        which, at = spans(ends[query], ends[query + 1])
        if self.chunk.repeated:
            pair, start = self._votes(name, docs, which, terms[at], place[at], ids, row, begin, size, np.ones(len(docs), np.int64) if many is None else many[chosen])
        else:
            lo, hi = self.find(name, docs[which], terms[at])
            tf = np.where(hi > lo, self.postings(name)[1][np.minimum(lo, max(len(self.postings(name)[0]) - 1, 0))], 0) if len(self.postings(name)[0]) else np.zeros(len(lo), np.int64)
            least = np.minimum.reduceat(tf, starts_of(size)) if len(size) else size
            is_least = np.flatnonzero((tf == least[which]) & (tf > 0))
            is_least = is_least[np.concatenate([[True], which[is_least][1:] != which[is_least][:-1]])] if len(is_least) else is_least
            # a word alone is a phrase wherever it stands
            out[chosen[which[is_least]]] = np.where(size[which[is_least]] == 1, tf[is_least], 0)
            is_least = is_least[size[which[is_least]] > 1]
            pair, anchor, off = which[is_least], terms[at[is_least]], place[at[is_least]].astype(np.int64)
            used = np.zeros(self.width(name) + 1, bool)
            used[anchor] = True
            token = np.flatnonzero(used[ids])
            key = row[token] * self.width(name) + ids[token]
            order = np.argsort(key, kind="stable")
            token, key, asked = token[order], key[order], docs[pair] * self.width(name) + anchor
            which, at = spans(np.searchsorted(key, asked), np.searchsorted(key, asked, "right"))
            pair, start = pair[which], token[at] - off[which]
            real = start >= begin[docs[pair]]
            pair, start = pair[real], start[real]
            which, at = spans(ends[query[pair]], ends[query[pair] + 1])
            there = start[which] + place[at]
            inside = there < (begin + sizes)[docs[pair[which]]]
            same = inside & (ids[np.where(inside, there, 0)] == terms[at])
            real = np.bincount(which, weights=~same, minlength=len(pair)) == 0
            pair, start = pair[real], start[real]
        order = np.lexsort((start, pair))
        out[chosen] += _apart(pair[order], start[order], size)
        return out

    def _votes(self, name, docs, which, terms, place, ids, row, begin, size, many):
        token = np.flatnonzero(ids >= 0)
        key = self.chunk.of[row[token]] * self.width(name) + ids[token]
        order = np.argsort(key, kind="stable")
        token, key, asked = token[order], key[order], docs[which] * self.width(name) + terms
        i, at = spans(np.searchsorted(key, asked), np.searchsorted(key, asked, "right"))
        start = token[at] - begin[row[token[at]]] - place[i].astype(np.int64)
        span = int(start.max(initial=0)) + 1
        held, n = counted(which[i[start >= 0]] * span + start[start >= 0])
        real = n * many[held // span] == size[held // span]
        return held[real] // span, held[real] % span


def _apart(pair: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each pair the starts (in order) that are no nearer than its size to the one taken before."""
    n = np.bincount(pair, minlength=len(size))
    close = np.flatnonzero((pair[1:] == pair[:-1]) & (start[1:] - start[:-1] < size[pair[1:]])) if len(pair) else pair
    for p in np.unique(pair[close]):
        lo, hi = np.searchsorted(pair, [p, p + 1])
        taken, free = 0, -1
        for x in start[lo:hi].tolist():
            if x >= free:
                taken, free = taken + 1, x + int(size[p])
        n[p] = taken
    return n


def pairs_of(docs: np.ndarray, query: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, by document."""
    key = counted(docs * max(n, 1) + query)[0]
    return key // max(n, 1), key % max(n, 1)


def _rows(chunk: Chunk, block: Block, docs: np.ndarray, query: np.ndarray, *more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([chunk.doc_langs(docs), block.items.take(pa.array(query)), chunk.doc_ids(docs), *[a for a, _ in more]],
                                      ["lang", "of", "doc_id", *[name for _, name in more]])


def task_search(texts: Texts, sent, required: tuple, near: tuple | None, groups: tuple | None, top: int, batches):
    """(lang, of, doc_id, score) of pairs that share all terms in one of ``required`` or a term of the ``near`` field.  With
    ``groups`` (of weighted fields) pairs are scored and the ``top`` best of a query and language in a chunk are kept."""
    block = sent.value
    for rows in chunks(batches, texts.columns):
        chunk = Chunk(rows, texts)
        found = Matches(chunk, block)
        rank = np.empty(len(chunk.first), np.int64)
        rank[pc.sort_indices(chunk.doc_ids(np.arange(len(rank))), null_placement="at_start").to_numpy()] = np.arange(len(rank))
        for a, z in slices(found.load(required, near and near[0])):
            whole = [found.complete(name, a, z) for name in required]
            docs, query = pairs_of(*(np.concatenate([w[i] for w in whole] or [np.zeros(0, np.int64)]) for i in (0, 1)), len(block.items))
            is_whole = np.ones(len(docs), bool)
            if near is not None:
                more = found.near(near[0], a, z)
                key, n = docs * len(block.items) + query, len(block.items)
                docs, query = pairs_of(np.concatenate([docs, more[0]]), np.concatenate([query, more[1]]), n)
                is_whole = np.isin(docs * n + query, key)
            score = np.zeros(len(docs))
            if groups is not None:
                def of(name):
                    return found.scores(name, docs, query, False)

                for group in groups:
                    parts = [weight * (of(f) if f in SPECIAL else 3.0 * of(f) + of(f + PLAIN)) for f, weight in group]
                    score += np.max(parts, axis=0)
                score[~is_whole] = 0
                if near is not None:
                    score += near[1] * of(near[0])
                order = np.lexsort((rank[docs], -np.round(score, 9), query, chunk.lang[docs]))
                group = chunk.lang[docs][order] * len(block.items) + query[order]
                first = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
                at = np.arange(len(group)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(group) else group
                order = order[at < top]
                docs, query, score = docs[order], query[order], score[order]
            yield _rows(chunk, block, docs, query, (pa.array(score), "score"))


def task_phrases(texts: Texts, sent, fields: tuple, batches):
    """(lang, of, doc_id, field, phrase_freq) of the queries that a task's documents hold as a phrase."""
    block = sent.value
    for rows in chunks(batches, texts.columns):
        chunk = Chunk(rows, texts)
        found = Matches(chunk, block)
        for name in fields:
            for a, z in slices(found.load([name])):
                docs, query, many, _ = found.holders(name, a, z)
                n = found.phrases(name, docs, query, many)
                docs, query, n = docs[n > 0], query[n > 0], n[n > 0]
                yield _rows(chunk, block, docs, query, (pa.array([name] * len(n), pa.string()), "field"), (pa.array(n), "phrase_freq"))


def _lists(columns: Sequence[np.ndarray], n: int, kind: pa.DataType, missing: Sequence[np.ndarray]) -> pa.Array:
    flat = np.stack(columns, axis=1).reshape(-1) if columns else np.zeros(0)
    gone = np.stack(missing, axis=1).reshape(-1) if columns else np.zeros(0, bool)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(columns), pa.int32()), pa.array(flat, kind, mask=gone))


def task_values(texts: Texts, sent, fields: tuple, phrases: tuple, batches):
    """(lang, of, doc_id, score, matched, n_terms, phrase) of the queries listed beside each document (``asked``): an entry a field
    of ``fields``, and of ``phrases``, null where there is nothing."""
    block = sent.value
    for rows in chunks(batches, texts.columns):
        chunk = Chunk(rows, texts)
        found, lists = Matches(chunk, block), rows["asked"].chunk(0)
        query = places(lists.flatten(), block.items)
        docs = chunk.of[pc.list_parent_indices(lists).to_numpy()]
        all_docs, all_query = pairs_of(docs[query >= 0], query[query >= 0], len(block.items))
        for i in range(0, len(all_docs), SLICE):
            docs, query = all_docs[i:i + SLICE], all_query[i:i + SLICE]
            scores = [found.scores(name, docs, query) for name in fields]
            freq = [found.phrases(name, docs, query) for name in phrases]
            none = [s[1] == 0 for s in scores]
            yield _rows(chunk, block, docs, query, *[(_lists([s[i] for s in scores], len(docs), kind, none), name) for i, (name, kind) in enumerate(
                (("score", pa.float64()), ("matched", pa.int64()), ("n_terms", pa.int32())))],
                (_lists(freq, len(docs), pa.int64(), [f == 0 for f in freq]), "phrase"))


def task_statistics(sent, fields: tuple, stats: tuple, aggs: tuple, batches):
    """(lang, of, value) of the (lang, of) given: for each field, statistic and aggregate over the query's terms, null where the
    query or the language has nothing in the field.  A term that the language lacks counts as 0."""
    block = sent.value
    for batch in batches:
        lang, query = places(batch.column("lang"), block.langs), places(batch.column("of"), block.items)
        kept = np.flatnonzero((lang >= 0) & (query >= 0))
        lang, query, columns, missing = lang[kept], query[kept], [], []
        for name in fields:
            ends, terms, _ = block.rows[analyzer_of(name)]
            n_docs = block.docs[name][0][lang]
            row = np.flatnonzero((ends[query + 1] > ends[query]) & (n_docs > 0))
            which, at = spans(ends[query[row]], ends[query[row] + 1])
            keys, df, ttf = block.stats[name]
            place = rank_in(keys, lang[row][which] * len(block.vocab[analyzer_of(name)]) + terms[at])
            df, ttf = (np.where(place >= 0, np.concatenate([x, [0]])[place], 0).astype(float) for x in (df, ttf))
            values = {"raw_df": df, "raw_ttf": ttf, "classic_idf": 1.0 + np.log((n_docs[row][which] + 1.0) / (df + 1.0))}
            size = (ends[query + 1] - ends[query])[row]
            gone = np.ones(len(lang), bool)
            gone[row] = False
            for stat in stats:
                x, n = values[stat], len(row)
                mean = np.bincount(which, weights=x, minlength=n) / size
                found = {"sum": lambda: np.bincount(which, weights=x, minlength=n), "min": lambda: np.minimum.reduceat(x, starts_of(size)),
                         "max": lambda: np.maximum.reduceat(x, starts_of(size)), "mean": lambda: mean,
                         "stddev": lambda: np.sqrt(np.bincount(which, weights=(x - mean[which]) ** 2, minlength=n) / size)}
                for agg in aggs:
                    column = np.zeros(len(lang))
                    if n:
                        column[row] = found[agg]()
                    columns.append(column)
                    missing.append(gone)
        at = pa.array(kept)
        yield pa.RecordBatch.from_arrays([batch.column("lang").take(at), batch.column("of").take(at), _lists(columns, len(kept), pa.float64(), missing)], ["lang", "of", "value"])
