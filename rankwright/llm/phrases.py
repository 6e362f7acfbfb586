"""Collocations of a corpus: phrases of two to four words, scored against their best parts, by language.

Counting goes through automata (``automata``).  Sequences are a language and 1 to 4 words.

1. Scan: each task turns its documents into shards of about ``SHARD_BYTES`` of text, which hold the
   words as numbers of the shard's own sorted vocabulary.
2. For each length, every shard sorts its distinct sequences and builds their count automata, one for each
   range of the sorted order (cut by language and the first two words, at marks drawn from the shards,
   so also a very frequent first word is divided).  A range unites the automata of all shards, sums the counts and
   keeps the sequences counted ``MIN_COUNT`` times or more.  Every shard is answered which of its own
   sequences were kept: the union is composed with what the shard had sent.
3. A sequence can be kept only if its parts were, so the shard drops words, then breaks its texts
   between word pairs, that were not kept, and only what is left is counted at the next length.  This loses
   nothing.
4. Parts: every range lists the first parts and rests of its candidates as automata for the ranges
   of the shorter lengths, which are composed with the counts there and answered.

Scores and the removal of phrases inside longer ones are exact DataFrame arithmetic in decimals and whole numbers.
Shuffled are automata and answers, never texts; a hot word, phrase or copied document is one
arc a shard.  The driver sees the marks only (some dozens for each shuffle partition).  With many
more shards than words in common, an automaton holds few sequences; ``shard_bytes`` then is the setting to raise.

Edge cases: a null text is empty; a null language is ``und``; rows are counted whatever their ``doc_id``, repeated
ones each time; phrases never cross the marks ``.,;:!?``, line ends or documents; an empty table
gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage, retire
from .automata import Automaton, distinct, pack, united, unpack, word_arrays, words_of
from .ordered import shuffle_partitions
from .textcodes import mix

SHARD_BYTES = 6 << 20
MAX_WORDS = 4
MIN_COUNT = 30
INSIDE_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
NO_LANGUAGE = "und"
MARKS_A_RANGE = 64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# kinds of bytes: 1 parts words, 2 ends a piece
_KIND = np.zeros(256, np.uint8)
_KIND[[*b" \t"]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2
_SHARDS = "shard bigint, size bigint, langs array<struct<lang:string,n:bigint>>, data binary"
_SENT = "n int, range int, origin bigint, data binary"
_PHRASES = "lang string, phrase string, a bigint, cuts array<struct<l:bigint,r:bigint>>"
Mark = tuple[bytes, ...]


class Shard:
    """Words of some documents: a vocabulary in byte order (languages first, marked by a line feed),
    the running words as its numbers (-1 breaks a phrase) and each word's language."""

    def __init__(self, vocabulary: pa.Array, words: np.ndarray, langs: np.ndarray):
        self.vocabulary, self.words, self.langs = vocabulary, words, langs

    def to_bytes(self) -> bytes:
        return pack(*word_arrays(self.vocabulary), self.words.astype("<i4"), self.langs.astype("<i4"))

    @classmethod
    def from_bytes(cls, data: bytes) -> "Shard":
        lengths, joined, words, langs = unpack(data)
        return cls(words_of(lengths, joined), words.astype(np.int64), langs.astype(np.int64))

    def sequences(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct rows (language, ``n`` words), their counts, and at each place the number of the
        row that starts there (-1: none)."""
        for found in self.all_sequences(n):
            pass
        return found

    def all_sequences(self, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``sequences`` of 1 to ``upto`` words."""
        place = np.flatnonzero(self.words >= 0)
        code, table = self.langs[place], None
        for k in range(upto):
            if k:
                inside = place + k < len(self.words)
                inside[inside] = self.words[place[inside] + k] >= 0
                place, code = place[inside], code[inside]
            number = np.full(len(self.words), -1, np.int64)
            if not len(place):
                yield np.zeros((0, k + 2), np.int64), np.zeros(0, np.int64), number
                continue
            found, code, counts = np.unique((code << 32) | self.words[place + k], return_inverse=True, return_counts=True)
            before = found >> 32
            head = before[:, None] if table is None else table[before]
            table = np.column_stack([head, found & 0xFFFFFFFF])
            number[place] = code
            yield table, counts, number

    def keep_words(self, kept: np.ndarray, number: np.ndarray) -> "Shard":
        """Without the words whose row was not kept; the vocabulary is what is left."""
        words = np.where((number >= 0) & np.append(kept, False)[number], self.words, -1)
        solid = (words >= 0) | np.append(True, words >= 0)[:-1]
        return self._renumbered(words[solid], self.langs[solid])

    def keep_pairs(self, kept: np.ndarray, number: np.ndarray) -> "Shard":
        """Broken between words whose pair was not kept; words in no kept pair are gone."""
        joined = (number >= 0) & np.append(kept, False)[number]
        wanted = joined | np.append(False, joined[:-1])
        copies = wanted.astype(np.int64) * np.where(joined, 1, 2)
        words, langs = np.repeat(self.words, copies), np.repeat(self.langs, copies)
        ends = np.cumsum(copies)[wanted & ~joined] - 1
        words[ends] = -1
        return self._renumbered(words, langs)

    def _renumbered(self, words: np.ndarray, langs: np.ndarray) -> "Shard":
        used = np.unique(np.concatenate([words[words >= 0], langs]))
        new = np.full(len(self.vocabulary) + 1, -1, np.int64)
        new[used] = np.arange(len(used))
        return Shard(self.vocabulary.take(pa.array(used)), new[words], new[langs])


def read_shard(texts: pa.Array, langs: pa.Array) -> tuple[Shard, dict[str, int]]:
    """Shard of some documents (texts as bytes), and the number of words of each language."""
    texts, langs = pc.fill_null(texts, b""), pc.fill_null(langs, NO_LANGUAGE).dictionary_encode()
    names = langs.dictionary.to_pylist()
    length = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    # one line feed after each text
    data = np.frombuffer(b"\n".join(texts.to_pylist()).translate(_LOWER) + b"\n", np.uint8)
    kind = _KIND[data]
    solid = kind == 0
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if solid[0]:
        edge = np.append(0, edge)
    start, end = edge[0::2], edge[1::2]
    words = words_of(end - start, data[solid]).dictionary_encode()
    # a word opens a piece if a mark stands between it and the word before
    ended = np.cumsum(kind == 2)
    opens = np.append(True, ended[start[1:]] != ended[end[:-1] - 1])[:len(start)]
    doc = np.searchsorted(np.cumsum(length + 1), start, side="right")
    owner = langs.indices.to_numpy()[doc].astype(np.int64) if len(doc) else doc
    every = pa.concat_arrays([pa.array([b"\n" + n.encode() for n in names], pa.binary()), words.dictionary])
    order = pc.sort_indices(every)
    rank = np.empty(len(every), np.int64)
    rank[order.to_numpy()] = np.arange(len(every))
    at = np.arange(len(start)) + np.cumsum(opens)  # a break before each piece
    stream, lang = np.full(len(start) + int(opens.sum()), -1, np.int64), np.zeros(len(start) + int(opens.sum()), np.int64)
    stream[at] = rank[len(names):][words.indices.to_numpy()]
    lang[at] = rank[owner]
    lang[at[opens] - 1] = rank[owner[opens]]
    counts = dict(zip(names, np.bincount(owner, minlength=len(names)).tolist()))
    return Shard(every.take(order), stream, lang), counts


def read_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``shard, size, langs, data``: the documents of each task in shards of about ``shard_bytes`` bytes."""
    schema = pa.schema([("shard", pa.int64()), ("size", pa.int64()), ("langs", pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())]))),
                        ("data", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[pa.Array, pa.Array]] = []
        size = 0

        def done() -> pa.RecordBatch:
            shard, words = read_shard(*(pa.concat_arrays(x) for x in zip(*held)))
            return pa.RecordBatch.from_pylist([{
                "shard": number, "size": int((shard.words >= 0).sum()), "langs": [{"lang": k, "n": n} for k, n in words.items()],
                "data": shard.to_bytes()}], schema=schema)

        for batch in batches:
            texts, langs = batch.column("text").cast(pa.binary()), batch.column("lang")
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            at = before = 0
            while at < len(texts):
                upto = min(int(np.searchsorted(ends, before + shard_bytes - size)) + 1, len(texts))
                held.append((texts.slice(at, upto - at), langs.slice(at, upto - at)))
                size, before, at = size + int(ends[upto - 1]) - before, int(ends[upto - 1]), upto
                if size >= shard_bytes:
                    yield done()
                    number, size = number + 1, 0
                    held.clear()
        if held:
            yield done()

    return docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .mapInArrow(scan, _SHARDS)


def marks(shards: DataFrame, n: int, ranges: int) -> list[Mark]:
    """Sorted starts of sequences of ``n`` words (language and two words) that cut their order into ranges."""
    total = shards.agg(F.sum("size")).first()[0] or 0
    wanted = MARKS_A_RANGE * ranges
    width = min(n, 2)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist()):
                shard = Shard.from_bytes(data)
                place = np.arange(len(shard.words), dtype=np.uint64)
                code = mix(place ^ mix(np.array([number * 8 + n], np.uint64)))
                some = np.flatnonzero(code % np.uint64(max(1, total)) < np.uint64(wanted))
                some = some[some + width <= len(shard.words)]
                for k in range(width):
                    some = some[shard.words[some + k] >= 0]
                words = shard.vocabulary.to_pylist()
                rows = [[words[shard.langs[p]], *(words[shard.words[p + k]] for k in range(width))] for p in some.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.binary()))], names=["mark"])

    if ranges < 2 or not total:
        return []
    drawn = sorted({tuple(map(bytes, r.mark)) for r in shards.select("shard", "data").mapInArrow(draw, "mark array<binary>").collect()})
    return sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []


def split(words: pa.Array, rows: np.ndarray, counts: np.ndarray, at: list[Mark]) -> Iterator[tuple[int, Automaton]]:
    """The automaton of each range's part of sorted rows."""
    known = words.to_pylist()
    edges = [0]
    for mark in at:
        lo, hi = edges[-1], len(rows)
        for d, word in enumerate(mark):
            number = bisect_left(known, word)
            column = rows[lo:hi, d]
            left = int(np.searchsorted(column, number, "left"))
            if number == len(known) or known[number] != word:
                lo += left
                break
            lo, hi = lo + left, lo + int(np.searchsorted(column, number, "right"))
        edges.append(lo)
    edges.append(len(rows))
    for r, (a, b) in enumerate(zip(edges, edges[1:])):
        if a < b:
            yield r, Automaton.build(words, rows[a:b], counts[a:b])


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    n, r, origin, data = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(r, pa.int32()), pa.array(origin, pa.int64()),
                                       pa.array(data, pa.binary())], names=["n", "range", "origin", "data"])


def send(shards: DataFrame, at: dict[int, list[Mark]]) -> DataFrame:
    """``n, range, origin, data``: the automata of every shard for each length of ``at`` and range."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist()):
                shard = Shard.from_bytes(data)
                for n, (rows, counts, _) in enumerate(shard.all_sequences(max(at)), 1):
                    if n in at:
                        yield _sent([(n, r, number, a.to_bytes()) for r, a in split(shard.vocabulary, rows, counts, at[n])])

    return shards.select("shard", "data").mapInArrow(build, _SENT)


def _bits(flags: np.ndarray) -> bytes:
    return pack(np.array([len(flags)], "<i8"), np.packbits(flags))


def unite(sent: DataFrame, least: int, answer: bool) -> DataFrame:
    """For each length and range the united automaton of sequences counted ``least`` times or more (``origin`` null),
    and with ``answer`` for each shard a bit for each sequence it sent: kept or not."""

    def work(table: pa.Table) -> pa.Table:
        n, r = table.column("n")[0].as_py(), table.column("range")[0].as_py()
        automata = [Automaton.from_bytes(d.as_py()) for d in table.column("data")]
        kept = united(automata, least)
        rows = [(n, r, None, kept.to_bytes())] if len(kept.source) else []
        if answer:
            rows += [(n, r, o.as_py(), _bits(kept.compose(a) > 0)) for o, a in zip(table.column("origin"), automata)]
        return pa.Table.from_batches([_sent(rows)])

    return sent.groupBy("n", "range").applyInArrow(work, _SENT)


def narrowed(shards: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """The shards without what was not kept among their sequences of ``n`` words."""

    def work(own: pa.Table, got: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table({"shard": pa.array([], pa.int64()), "size": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})
        shard = Shard.from_bytes(own.column("data")[0].as_py())
        rows, _, number = shard.sequences(n)
        kept = np.zeros(0, bool)
        for _, data in sorted(zip(got.column("range").to_pylist(), got.column("data").to_pylist())):
            count, bits = unpack(data)
            kept = np.append(kept, np.unpackbits(bits, count=int(count[0])).astype(bool))
        if len(kept) != len(rows):
            raise ValueError("a shard was answered for other sequences than it sent")
        left = shard.keep_words(kept, number) if n == 1 else shard.keep_pairs(kept, number)
        return pa.table({"shard": own.column("shard").cast(pa.int64()), "size": pa.array([int((left.words >= 0).sum())], pa.int64()),
                         "data": pa.array([left.to_bytes()], pa.binary())})

    return shards.select("shard", "size", "data").groupBy("shard").cogroup(
        answers.select(F.col("origin").alias("shard"), "range", "data").groupBy("shard")) \
        .applyInArrow(work, "shard bigint, size bigint, data binary")


def parts(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct first parts and rests of ``size`` words of rows (language, words), and the number of each
    row's first part and rest among them."""
    n = rows.shape[1] - 1
    both = np.concatenate([rows[:, :size + 1], np.column_stack([rows[:, 0], rows[:, n - size + 1:]])])
    found, number = distinct(both)
    return found, number[:len(rows)], number[len(rows):]


def ask_parts(kept: DataFrame, at: dict[int, list[Mark]]) -> DataFrame:
    """Automata of the parts of all candidates for the ranges that count them; ``origin`` names who asks."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, data in zip(batch.column("origin").to_pylist(), batch.column("data").to_pylist()):
                held = Automaton.from_bytes(data)
                rows, _ = held.paths()
                for size in range(1, held.depth - 1):
                    found, _, _ = parts(rows, size)
                    yield _sent([(size, r, origin, a.to_bytes())
                                 for r, a in split(held.words, found, np.zeros(len(found), np.int64), at[size])])

    return kept.select("origin", "data").mapInArrow(build, _SENT)


def answer_parts(kept: DataFrame, asked: DataFrame) -> DataFrame:
    """The count of every part that was asked for, in the order of the asking automaton."""

    def work(own: pa.Table, queries: pa.Table) -> pa.Table:
        if not queries.num_rows:
            return pa.Table.from_batches([_sent([])])
        if not own.num_rows:
            raise ValueError("parts of a kept phrase were not kept")
        held = Automaton.from_bytes(own.column("data")[0].as_py())
        return pa.Table.from_batches([_sent([
            (n.as_py(), r.as_py(), o.as_py(), pack(held.compose(Automaton.from_bytes(d.as_py())).astype("<i8")))
            for n, r, o, d in zip(*(queries.column(c) for c in ("n", "range", "origin", "data")))])])

    return kept.select("n", "range", "data").groupBy("n", "range").cogroup(asked.groupBy("n", "range")).applyInArrow(work, _SENT)


def _candidates(kept: DataFrame, answers: DataFrame) -> DataFrame:
    """``lang, phrase, a, cuts``: every candidate with the counts of its parts, by the number of words before the cut."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()),
                        ("cuts", pa.list_(pa.struct([("l", pa.int64()), ("r", pa.int64())])))])

    def work(own: pa.Table, got: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.Table.from_pylist([], schema=schema)
        held = Automaton.from_bytes(own.column("data")[0].as_py())
        rows, counts = held.paths()
        n = held.depth - 1
        told: dict[int, list[np.ndarray]] = {size: [] for size in range(1, n)}
        for size, _, data in sorted(zip(*(got.column(c).to_pylist() for c in ("n", "range", "data")))):
            told[size].append(unpack(data)[0])
        first, rest = {}, {}
        for size in range(1, n):
            found, heads, tails = parts(rows, size)
            value = np.concatenate(told[size])
            if len(value) != len(found) or not value.all():
                raise ValueError("a part of a kept phrase has no count")
            first[size], rest[size] = value[heads].tolist(), value[tails].tolist()
        words = [w.decode() for w in held.words.to_pylist()]
        out = []
        for i, row in enumerate(rows.tolist()):
            out.append({"lang": words[row[0]][1:], "phrase": " ".join(words[j] for j in row[1:]), "a": int(counts[i]),
                        "cuts": [{"l": first[k][i], "r": rest[n - k][i]} for k in range(1, n)]})
        return pa.Table.from_pylist(out, schema=schema)

    return kept.select("origin", "data").groupBy("origin").cogroup(answers.groupBy("origin")).applyInArrow(work, _PHRASES)


def candidates(shards: DataFrame, least: int = MIN_COUNT, max_words: int = MAX_WORDS, ranges: int | None = None) -> DataFrame:
    """Every phrase of 2 to ``max_words`` words counted ``least`` times or more, by language (``lang, phrase, a, cuts``)."""
    ranges = ranges or shuffle_partitions(shards)
    at: dict[int, list[Mark]] = {}
    kept, given = None, shards
    for sizes in ([1], [2], list(range(3, max_words + 1))):
        sizes = [n for n in sizes if n <= max_words]
        if not sizes:
            break
        at |= {n: marks(shards, n, ranges) for n in sizes}
        more = max(sizes) < max_words
        found = cut_lineage(unite(send(shards, {n: at[n] for n in sizes}), least, more))
        held = cut_lineage(found.where("origin is null").drop("origin"))
        kept = held if kept is None else kept.unionByName(held)
        before, shards = shards, cut_lineage(narrowed(shards, found.where("origin is not null"), sizes[0])) if more else None
        retire(found, *([before] if before is not given else []))
    phrases = kept.where("n > 1").withColumn("origin", F.shiftleft(F.col("n").cast("long"), 32) + F.col("range"))
    return _candidates(phrases, answer_parts(kept, ask_parts(phrases, at)))


def scored(found: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the lowest-scoring cut (ties: the first)."""
    by_cut = F.expr(f"transform(cuts, (c, i) -> struct(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) "
                    "div cast(c.l + c.r as decimal(20,0)) as score, i as k, c.l as l, c.r as r))")
    return found.select("lang", "phrase", "a", F.array_min(by_cut).alias("_best"))         .select("lang", "phrase", "a", "_best.l", "_best.r", "_best.score")


def inside_longer(found: DataFrame) -> DataFrame:
    """``lang, phrase, longest``: the highest count of a longer candidate around each contiguous part of two or more words."""
    words = F.split("phrase", " ")
    spans = F.expr("""flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))))""")
    return found.select("lang", "a", words.alias("w")).where("size(w) > 2")         .select("lang", "a", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longest"))


def mine(docs: DataFrame, top: int = TOP, least: int = MIN_COUNT, max_words: int = MAX_WORDS, shard_bytes: int = SHARD_BYTES,
         ranges: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of ``docs`` (``text, lang``)."""
    shards = cut_lineage(read_shards(docs, shard_bytes))
    totals = shards.select(F.inline("langs")).groupBy("lang").agg(F.sum("n").alias("n"))
    found = cut_lineage(candidates(shards, least, max_words, ranges or shuffle_partitions(docs)))
    kept = scored(found).join(inside_longer(found), ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest").cast("decimal(20,0)") < INSIDE_PERCENT * F.col("a").cast("decimal(20,0)")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH p AS (SELECT row_number() OVER () AS d, lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) AS piece FROM (
             SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (
        SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= {MIN_COUNT}),
cut AS (SELECT lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:k], ' ') AS y FROM (
          SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cut.lang, cut.phrase, cut.a, j, l.a AS l, r.a AS r, CAST(CAST({SCALE} AS HUGEINT) * cut.a // (l.a + r.a) AS BIGINT) AS score
      FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s) WHERE o = 1),
part AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (
           SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
longest AS (SELECT lang, phrase, max(a) AS m FROM part GROUP BY ALL),
r AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM best b LEFT JOIN longest USING (lang, phrase)
      WHERE m IS NULL OR CAST(100 AS HUGEINT) * m < CAST({INSIDE_PERCENT} AS HUGEINT) * a)
SELECT r.lang, rank, phrase, a, l, r.r, n, score FROM r JOIN total USING (lang) WHERE rank <= {TOP}
"""
