"""Token-id files: a shared zstandard dictionary, one frame a document, an offset index.

Format (a folder): ``dictionary`` holds one row ``(sha256, data, width, tokenizer)``;
``shards`` holds rows of about ``SHARD_BYTES`` with the frames of consecutive documents (in
ascending ``doc_id`` order, over all ranges and shards) and their index: ids of the documents,
number of ids, and byte offset of each frame.  Every shard names the dictionary's
hash.  A frame is the little-endian id array (``width`` bytes an id) compressed by itself,
so one short document is read with one slice and one decompression (``lookup``).

The dictionary is trained on the serialized ids of about ``SAMPLE_DOCS`` documents, chosen by
a hash of the id (at most ``SAMPLE_BYTES`` of each); it only affects the size of the files.

Encoding is the tokenizers library's.  Texts are cut where its byte-level pre-tokenizer always
cuts, and a segment is encoded once while it stays in the worker's bounded cache of two
generations; the ids are those of the whole text.  Texts for other pre-tokenizers are not cut.

Edge cases: a null text counts as empty (its frame holds the end id only); a null
``doc_id`` comes first; rows of equal ``doc_id`` are ordered by text; whole texts are encoded;
without rows there are no shards; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import ordered

END_ID = 0
SHARD_BYTES = 4 << 20
SAMPLE_DOCS = 1500
SAMPLE_BYTES = 1 << 14
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
CACHE_SEGMENTS = 700_000
CACHED_BYTES = 100
BLOCK_BYTES = 8 << 20
JOINED = 64
SHARDS = ("range int, shard int, start_in_range bigint, first_doc_id bigint, last_doc_id bigint, n_ids bigint, "
          "dictionary string, doc_ids array<bigint>, counts array<bigint>, offsets array<bigint>, data binary")
TOKENS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
# white space other than single spaces and line feeds between other characters
_IRREGULAR = ["  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
# before a single line feed or instead of a single space, both between non-space characters
_CUT = re.compile(r"(?<=\S)(?:(?=\n\S)| (?=\S))")


def default_tokenizer() -> str:
    """Path of the public byte-level vocabulary (installed on every machine)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def cut(text: str | None) -> list[str]:
    """Segments of a text: the first as it is, the others after a line feed (kept) or a space (left out)."""
    if not text:
        return []
    if text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, _IRREGULAR)):
        return _CUT.split(text)
    return text.replace("\n", " \n").split(" ")


def _byte_values() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable Latin-1 stands for itself, the
    other bytes follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_bytes(tokenizer) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer; added tokens as their text."""
    value = _byte_values()
    out = []
    for i in range(tokenizer.get_vocab_size()):
        token = tokenizer.id_to_token(i)
        try:
            out.append(bytes(value[c] for c in token))
        except KeyError:
            out.append(token.encode())
    return out


def spread_out(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices ``first[i] .. first[i] + size[i] - 1`` one after the other."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


# kinds of bytes: others, ASCII letters (and letters of two bytes), digits, marks, apostrophe, space, line feed,
# other white space, first bytes of characters that may be white space
_OTHER, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _SPACE, _FEED, _WHITE, _DOUBTFUL = range(9)
_CUT_BEFORE_LAST, _CUT_BETWEEN = 1, 2


def _kinds_of_bytes() -> bytes:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    for c in range(33, 127):
        kinds[c] = _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _MARK
    kinds[ord("'")] = _APOSTROPHE
    kinds[[*range(9, 14), *range(28, 32)]] = _WHITE
    kinds[ord(" ")], kinds[ord("\n")] = _SPACE, _FEED
    kinds[[0xC2, 0xE1, 0xE2, 0xE3]] = _DOUBTFUL
    return kinds.tobytes()


def _cuts_of_pairs() -> bytes:
    """What two neighbouring kinds (16 * first + second) tell: a cut between them, or before the first."""
    cuts = np.zeros(256, dtype=np.uint8)
    family = {_LETTER: 1, _DIGIT: 2, _MARK: 3, _APOSTROPHE: 3}
    for one in family:
        for two in family:
            if family[one] != family[two] and (one, two) != (_APOSTROPHE, _LETTER):
                cuts[16 * one + two] = _CUT_BETWEEN
    for two in (_OTHER, *family):
        cuts[16 * _SPACE + two] = _CUT_BEFORE_LAST
        cuts[16 * _FEED + two] = _CUT_BEFORE_LAST | _CUT_BETWEEN
    return cuts.tobytes()


_KINDS, _CUTS = _kinds_of_bytes(), _cuts_of_pairs()
_WHITE_CHARS = [c.encode() for c in map(chr, range(128, 0x3001)) if c.isspace()]


def segment_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Offsets at which segments of texts start: ``data`` holds their bytes, text ``i`` ends at ``bounds[i + 1]``.

    The byte-level pre-tokenizer always cuts there: before the last space or line feed before a
    character that is no white space, after such a line feed, and where ASCII letters, digits and marks meet (but not
    between an apostrophe and a letter)."""
    n = len(data)
    starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    if n < 2:
        return starts
    kinds = np.frombuffer(bytearray(data.tobytes().translate(_KINDS)), dtype=np.uint8)
    # U+00C0 to U+00FF but two signs, and U+0400 to U+047F, are letters
    lead = np.flatnonzero((data[:-1] == 0xC3) | (data[:-1] == 0xD0) | (data[:-1] == 0xD1))
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
    kinds[lead] = kinds[lead + 1] = _LETTER
    pairs = kinds[:-1] << 4
    pairs |= kinds[1:]
    for at in np.flatnonzero((pairs == 16 * _SPACE + _DOUBTFUL) | (pairs == 16 * _FEED + _DOUBTFUL)).tolist():
        if data[at + 1:at + 4].tobytes().startswith(tuple(_WHITE_CHARS)):
            pairs[at] = 0
        else:
            pairs[at] &= 0xF0
    inner = bounds[(bounds > 0) & (bounds < n)]
    pairs[inner - 1] = 0
    cuts = np.frombuffer(pairs.tobytes().translate(_CUTS), dtype=np.uint8)
    is_start = np.zeros(n, dtype=bool)
    is_start[:-1] = cuts & _CUT_BEFORE_LAST
    is_start[1:] |= cuts >= _CUT_BETWEEN
    is_start[starts] = True
    return np.flatnonzero(is_start)


class Encoder:
    """Ids of whole texts as serialized arrays, through a bounded cache of segments.

    Texts are cut a block at a time, a block's distinct segments are looked up in the cache, and the library
    encodes those that are new.  Its pre-tokenizer leaves a word (letters or digits, a space before it) in
    one piece, so new words go to its model directly, many joined by a byte that no merge takes; a
    tokenizer without such a byte, or of another kind, gets the segments or whole texts as they are."""

    def __init__(self, path: str, width: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype(f"<u{width}")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.asked: set[str] = set()
        self.strange: set[str] = set()
        first, model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.cuts = (isinstance(first, pre_tokenizers.ByteLevel) and first.use_regex and not first.add_prefix_space
                     and self.tokenizer.normalizer is None)
        self.separator = None
        if self.cuts and isinstance(model, models.BPE) and not (model.dropout or model.ignore_merges or model.continuing_subword_prefix
                                                                or model.end_of_word_suffix):
            vocab, value = self.tokenizer.get_vocab(with_added_tokens=False), _byte_values()
            merged = set("".join(t for t in vocab if len(t) > 1))
            free = [c for c, b in value.items() if b in (0xC0, 0xC1, *range(0xF5, 0x100)) and c not in merged]
            if free and all(c in vocab for c in value):
                self.separator, self.separator_id = bytes([value[free[0]]]), vocab[free[0]]
                self.chars = np.zeros(256, dtype="<u4")
                self.chars[list(value.values())] = list(map(ord, value))
                self.words = Tokenizer.from_file(path)
                self.words.pre_tokenizer = None

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        kind = "H" if self.kind.itemsize == 2 else "I"
        return [array(kind, e.ids).tobytes() for e in found]

    def _no_letters(self, texts: list[str]) -> set[str]:
        """Characters that are letters here but not to the library, which is asked once a character."""
        new = set("".join(texts)).difference(self.asked)
        self.asked |= new
        self.strange.update(c for c in new if c.isalpha() and len(self.tokenizer.pre_tokenizer.pre_tokenize_str("a" + c)) > 1)
        return self.strange

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words by the model alone."""
        out, size, apart = [], self.kind.itemsize, self.separator
        for at in range(0, len(words), JOINED * 256):
            some = words[at:at + JOINED * 256]
            joined = [self.chars[np.frombuffer(apart.join(some[i:i + JOINED]) + apart, dtype=np.uint8)].tobytes().decode("utf-32-le")
                      for i in range(0, len(some), JOINED)]
            ids = array("I")
            for e in self.words.encode_batch_fast(joined, add_special_tokens=False):
                ids.extend(e.ids)
            found = np.frombuffer(ids, dtype=np.uint32)
            ends = np.flatnonzero(found == self.separator_id)
            if len(ends) != len(some):
                raise ValueError("the model joined words")
            data, ends = found.astype(self.kind).tobytes(), (ends * size).tolist()
            out.extend(map(data.__getitem__, map(slice, [0, *(e + size for e in ends[:-1])], ends)))
        return out

    def _new_ids(self, segments: list[bytes]) -> list[bytes]:
        texts = [s.decode() for s in segments]
        is_word = [False] * len(texts)
        if self.separator:
            bare = [t[1:] if t[0] == " " else t for t in texts]
            is_word = [b.isalpha() or (b.isdecimal() and b.isascii()) for b in bare]
            strange = self._no_letters(bare)
            if strange:
                is_word = [w and strange.isdisjoint(b) for b, w in zip(bare, is_word)]
        words = iter(self._word_ids([s for s, w in zip(segments, is_word) if w]))
        rest = iter(self._ids([t for t, w in zip(texts, is_word) if not w]))
        return [next(words) if w else next(rest) for w in is_word]

    def _segment_ids(self, segments: list[bytes]) -> list[bytes]:
        """Ids of distinct segments; new ones enter the young generation, but long ones."""
        found = list(map(self.young.get, segments))
        missing = [i for i, f in enumerate(found) if f is None]
        if len(self.young) + len(missing) > CACHE_SEGMENTS:
            self.old, self.young = self.young, {}
        learnt = {}
        for i in missing:
            found[i] = self.old.get(segments[i])
            if found[i] is not None:
                learnt[segments[i]] = found[i]
        missing = [i for i in missing if found[i] is None]
        for i, ids in zip(missing, self._new_ids([segments[i] for i in missing])):
            found[i] = ids
            if len(segments[i]) <= CACHED_BYTES:
                learnt[segments[i]] = ids
        self.young.update(learnt)
        return found

    def _block(self, data: pa.Buffer, bounds: np.ndarray) -> list[bytes]:
        flat = np.frombuffer(data, dtype=np.uint8)
        starts = segment_starts(flat, bounds) if self.cuts else bounds[:-1][bounds[:-1] < bounds[1:]]
        raw = flat.tobytes()
        # a text with the string of an added token stays whole
        for mark in self.special:
            at = raw.find(mark)
            while at >= 0:
                i = int(np.searchsorted(bounds, at, side="right"))
                starts = starts[(starts <= bounds[i - 1]) | (starts >= bounds[i])]
                at = raw.find(mark, max(at + 1, int(bounds[i]) - len(mark) + 1))
        edges = np.append(starts, len(flat)).astype(np.int64)
        segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), data])
        coded = segments.dictionary_encode()
        known = self._segment_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        taken = pa.array(known, pa.large_binary()).take(coded.indices)
        if not len(taken):
            return [b""] * (len(bounds) - 1)
        _, offsets, ids = taken.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[:len(taken) + 1][np.searchsorted(edges, bounds)].tolist()
        ids = ids.to_pybytes()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def each(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, without the end id, block by block."""
        column = pc.fill_null(texts.cast(pa.large_string()), "")
        at = 0
        bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else []
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, side="right")) - 1)
            first, last = int(bounds[at]), int(bounds[end])
            if first == last:
                yield from [b""] * (end - at)
            else:
                yield from self._block(column.buffers()[2].slice(first, last - first), bounds[at:end + 1] - first)
            at = end

    def serialized(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, without the end id."""
        return list(self.each(pa.array(texts, pa.large_string())))


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, width: int) -> Encoder:
    """The worker's encoder; its cache outlives a task."""
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = Encoder(path, width)
    return _ENCODERS[path, width]


def id_width(path: str) -> int:
    """Bytes an id needs: 2 or 4."""
    from tokenizers import Tokenizer
    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, path: str, width: int) -> bytes:
    """Dictionary from a bounded sample of serialized documents (empty without data)."""
    total = docs.count()
    rate = min(1.0, SAMPLE_DOCS / max(1, total))
    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(rate * (1 << 30))).select("text")

    def encode(batches):
        encoder = encoder_of(path, width)
        for batch in batches:
            data = [d[:SAMPLE_BYTES] for d in encoder.each(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], names=["data"])

    rows = some.mapInArrow(encode, "data binary").limit(2 * SAMPLE_DOCS).collect()
    samples = sorted(bytes(r["data"]) for r in rows if r["data"])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:  # too few samples to train on: their content is the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _codec(dictionary: bytes):
    own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=True),
            zstandard.ZstdDecompressor(dict_data=own))


class _Shard:
    def __init__(self, number: int, start: int):
        self.number, self.start = number, start
        self.ids, self.counts, self.offsets, self.data, self.size = [], [], [], [], 0

    def add(self, doc_id, count: int, frame: bytes):
        self.ids.append(doc_id)
        self.counts.append(count)
        self.offsets.append(self.size)
        self.data.append(frame)
        self.size += len(frame)

    def row(self, number: int, dictionary: str) -> dict:
        known = [i for i in self.ids if i is not None]
        return {"range": number, "shard": self.number, "start_in_range": self.start,
                "first_doc_id": min(known, default=None), "last_doc_id": max(known, default=None),
                "n_ids": sum(self.counts), "dictionary": dictionary, "doc_ids": self.ids, "counts": self.counts,
                "offsets": self.offsets, "data": b"".join(self.data)}


_SHARD_TYPE = pa.schema([
    ("range", pa.int32()), ("shard", pa.int32()), ("start_in_range", pa.int64()), ("first_doc_id", pa.int64()),
    ("last_doc_id", pa.int64()), ("n_ids", pa.int64()), ("dictionary", pa.string()), ("doc_ids", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("data", pa.binary())])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None) -> None:
    """Encode every text and write the files under ``folder`` (any Spark file system)."""
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    width = id_width(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train_dictionary(rows, path, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, dictionary, width, os.path.basename(path))],
                          "sha256 string, data binary, width int, tokenizer string") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")
    n = ordered.shuffle_partitions(docs)
    keyed = rows.withColumn("key", ordered.order_key(F.col("doc_id")))
    dealt = ordered.deal(keyed.withColumn("range", ordered.range_of(F.col("key"), ordered.cuts(rows, n))), n,
                         "range", "key", "text")
    end = np.array([END_ID], dtype=f"<u{width}").tobytes()

    def encode(batches):
        encoder, (compressor, _) = encoder_of(path, width), _codec(dictionary)
        number, shard = 0, _Shard(0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column("range")[0].as_py()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.each(batch.column("text"))):
                ids += end
                shard.add(doc_id, len(ids) // width, compressor.compress(ids))
                if shard.size >= SHARD_BYTES:
                    row = shard.row(number, digest)
                    yield pa.RecordBatch.from_pylist([row], schema=_SHARD_TYPE)
                    shard = _Shard(shard.number + 1, shard.start + row["n_ids"])
        if shard.ids:
            yield pa.RecordBatch.from_pylist([shard.row(number, digest)], schema=_SHARD_TYPE)

    dealt.select("range", "doc_id", "text").mapInArrow(encode, SHARDS).write.parquet(f"{folder}/shards")


def _read_dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary of {folder} does not match its hash")
    return row["sha256"], data, row["width"]


def frame_ids(data: bytes, offsets: list[int], i: int, decompressor, width: int) -> np.ndarray:
    """Ids of document ``i`` of a shard, from its own frame."""
    end = offsets[i + 1] if i + 1 < len(offsets) else len(data)
    return np.frombuffer(decompressor.decompress(data[offsets[i]:end]), dtype=f"<u{width}").astype("<u4")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files."""
    digest, dictionary, width = _read_dictionary(spark, folder)
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    # one row a range: bounded by the number of shuffle partitions at writing
    totals = shards.groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_start"))
    placed = shards.join(F.broadcast(starts), "range").select(
        (F.col("range_start") + F.col("start_in_range")).alias("start"), "dictionary", "doc_ids", "counts", "offsets", "data")

    def decode(batches):
        _, decompressor = _codec(dictionary)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["dictionary"] != digest:
                    raise ValueError("a shard was written with another dictionary")
                crc = []
                for k, count in enumerate(row["counts"]):
                    ids = frame_ids(row["data"], row["offsets"], k, decompressor, width)
                    if len(ids) != count:
                        raise ValueError("a frame does not hold the ids its index tells")
                    crc.append(zlib.crc32(ids.tobytes()))
                counts = np.array(row["counts"], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + np.cumsum(counts) - counts),
                     pa.array(counts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(decode, TOKENS)


def lookup(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of some documents: their shards by id range, then only their frames."""
    digest, dictionary, width = _read_dictionary(spark, folder)
    wanted = sorted(set(doc_ids))
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    near = F.lit(False)
    for d in wanted:
        near = near | F.lit(d).between(F.col("first_doc_id"), F.col("last_doc_id"))
    asked = set(wanted)

    def decode(batches):
        _, decompressor = _codec(dictionary)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                hits = [k for k, d in enumerate(row["doc_ids"]) if d in asked]
                ids = [frame_ids(row["data"], row["offsets"], k, decompressor, width).astype(np.int64) for k in hits]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][k] for k in hits], pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
                    names=["doc_id", "ids"])

    return shards.where((F.col("dictionary") == digest) & near).select("doc_ids", "offsets", "data") \
        .mapInArrow(decode, "doc_id bigint, ids array<bigint>")
