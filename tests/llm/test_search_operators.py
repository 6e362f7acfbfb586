"""Tokens, repeated strings, fingerprints, leaks, near duplicates and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from rankwright.llm import decontam, lzprint, neardup, queries, substrings, suffixsort, textcodes, tokens

SF001 = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def documents():
    return duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet' order by doc_id").fetchall()


def same_as_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF001}/{t}.parquet'")
    res = con.execute(queries.ORACLE[key])
    names = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=str)
    got = sorted((tuple(r[n] for n in names) for r in queries.QUERIES[key](spark, SF001).collect()), key=str)
    assert got == want


# -- text codes --------------------------------------------------------------
def test_shingle_codes_equal_word_tuples():
    rng = random.Random(1)
    texts = ["".join(rng.choices(["a", "B", "é", " ", "\n", "\x0b", "cd"], k=rng.randint(0, 40))) for _ in range(400)] + [None, ""]
    codes: dict = {}
    for first, held in textcodes.blocks(texts, 300):
        found, offset = textcodes.distinct_shingles(held)
        for i in range(len(held)):
            own = set(shingles(texts[first + i]))
            assert len(own) == offset[i + 1] - offset[i]
            ordered, at = textcodes.Words(held[i:i + 1]).shingles()
            for s, c in zip(shingles(texts[first + i]), ordered.tolist()):
                assert codes.setdefault(s, c) == c
            assert sorted(set(ordered.tolist())) == found[offset[i]:offset[i + 1]].tolist()
    assert len(set(codes.values())) == len(codes)


# -- tokens ------------------------------------------------------------------
def test_segments_encode_like_whole_texts():
    enc = tokens.Encoder(tokens.default_tokenizer(), 2)
    rng = random.Random(1)
    bits = [" ", "\n", "  ", "\t", "a", "B", "é", "1", "'s", "'", ".", "!?", "\x1c", "\x85", "　", "<|endoftext|>", "漢", "\r\n"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(5000)] + [t for _, t in documents()]
    whole = enc.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert enc.serialized(texts) == [np.array(e.ids, dtype="<u2").tobytes() for e in whole]


def test_cuts_fall_where_the_library_cuts(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 50)
    enc = tokens.Encoder(tokens.default_tokenizer(), 2)
    rng = random.Random(2)
    bits = [" ", " ", " ", "\n", "\t", "\x1c", "\x85", "\u3000", "\u2003", "\u200b", "word", "B", "é", "ß", "Ж", "×", "÷", "ğ", "漢", "\u0301", "ª", "²",
            "٣", "Ⅷ", "12", "'", "'s", "'ll", ".", "!?", "-", "“", "<|endoftext|>", "\x00", "\u0870", "\U00031350"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(20000)] + [None, ""]
    whole = enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert enc.serialized(texts) == [np.array(e.ids, dtype="<u2").tobytes() for e in whole]


def test_new_words_reach_the_library_joined():
    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    enc = tokens.Encoder(tokens.default_tokenizer(), 2)
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß", k=12)) for _ in range(5000))
    want = np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()
    enc.tokenizer, enc.words = Counted(enc.tokenizer), Counted(getattr(enc, "words", None))
    assert enc.serialized([text]) == [want]
    assert enc.tokenizer.texts + enc.words.texts < 500


def test_other_pre_tokenizers_get_whole_texts(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers
    other = Tokenizer.from_file(tokens.default_tokenizer())
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    other.save(str(tmp_path / "other.json"))
    texts = ["one two\nthree (four)", "", "five's 6x"]
    assert tokens.Encoder(str(tmp_path / "other.json"), 2).serialized(texts) == [
        np.array(other.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]


def test_token_cache_generations(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_SEGMENTS", 20)
    enc = tokens.Encoder(tokens.default_tokenizer(), 2)
    texts = [t for _, t in documents()[:40]]
    whole = enc.tokenizer.encode_batch(texts, add_special_tokens=False)
    got = [enc.serialized([t])[0] for t in texts]
    assert got == [np.array(e.ids, dtype="<u2").tobytes() for e in whole]


def test_token_files(spark, tmp_path):
    rows = documents()[:120] + [(500000, None), (500001, ""), (500002, "x " * 30000), (None, "no id"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("range", F.lit("clash"))
    tokens.write_tokens(docs, str(tmp_path / "t"))
    got = tokens.read_digests(spark, str(tmp_path / "t")).orderBy("start").collect()
    tok = tokens.Encoder(tokens.default_tokenizer(), 2).tokenizer
    start = 0
    for (doc_id, text), r in zip(sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), got, strict=True):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (
            doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    one = tokens.lookup(spark, str(tmp_path / "t"), [500000, 5]).collect()
    assert {r.doc_id: len(r.ids) for r in one} == {500000: 1, 5: len(tok.encode(dict(rows)[5], add_special_tokens=False).ids) + 1}
    tokens.write_tokens(docs.limit(0), str(tmp_path / "none"))
    assert tokens.read_digests(spark, str(tmp_path / "none")).count() == 0


# -- repeated strings --------------------------------------------------------
def test_deep_shallow_order():
    rng = random.Random(2)
    for _ in range(100):
        base, rows = bytes(rng.choices(b"ab", k=50)), []
        for _ in range(rng.randint(0, 60)):
            b = bytearray(base)
            for _ in range(rng.randint(0, 3)):
                b[rng.randint(0, 49)] = rng.choice(b"abz\x00\xff")
            rows.append(bytes(b))
        order, cls = suffixsort.order_heads(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), 50))
        assert [rows[i] for i in order] == sorted(rows)
        assert [sorted(set(rows))[c] for c in cls] == sorted(rows)


def brute_strings(rows):
    seen, out = {}, {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            seen[b[i:i + 50]] = min(seen.get(b[i:i + 50], d), d)
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if seen[b[i:i + 50]] < d:
                gone[i:i + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out[d] = (d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed, batch_docs", [(0, 7), (1, 40), (2, 1000)])
def test_repeated_strings_equal_brute_force(spark, seed, batch_docs):
    rng = random.Random(seed)
    bits = ["".join(rng.choices("abcé \n", k=rng.randint(20, 200))) for _ in range(8)] + ["a" * 150, "ab" * 60, "x" * 49, "y" * 50]
    rows = [(d, "".join(rng.choice(bits) if rng.random() < 0.6 else "".join(rng.choices("abcdef ", k=rng.randint(0, 80)))
                        for _ in range(rng.randint(0, 6))) if rng.random() < 0.95 else None) for d in rng.sample(range(1000), 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("batch", F.lit("clash"))
    got = {r.doc_id: tuple(r) for r in substrings.repeated_strings(docs, batch_docs).collect()}
    assert got == brute_strings(rows)


@pytest.mark.parametrize("hot_runs", [0, 5, 40])
def test_hot_signatures_are_split(spark, hot_runs):
    rng = random.Random(hot_runs)
    passage = "".join(rng.choices("abcdefgh ", k=90))
    rows = [(d, "".join(rng.choices("abcdefgh ", k=rng.randint(0, 60))) + passage + "".join(rng.choices("abcdefgh ", k=rng.randint(0, 60)))
             + rng.choice(["", passage[:70], "ab" * 60])) for d in rng.sample(range(1000), 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r) for r in substrings.repeated_strings(docs, 20, hot_runs).collect()}
    assert got == brute_strings(rows)


def test_groups_of_a_hot_signature_are_bounded():
    """Edges of one passage: the contents of one signature that meet in a class, over all batches."""
    rng = random.Random(1)
    passage = "".join(rng.choices("abcdefgh ", k=200))
    held = [pa.table({"doc_id": list(range(b * 50, b * 50 + 50)), "batch": [b] * 50, "text": [
        "".join(rng.choices("abcdefgh ", k=60)) + passage + "".join(rng.choices("abcdefgh ", k=60)) for _ in range(50)]})
        for b in range(6)]

    def largest(hot_runs):
        signs = pa.concat_tables([substrings._signatures_of(t, 1) for t in held])
        shared = substrings._shared_of(signs, hot_runs)
        contents = Counter()
        for b, docs in enumerate(held):
            own = shared.filter(pc.equal(shared["batch"], b))
            sent = substrings._runs_of(docs, own, 1)["data"][0].as_py()
            sign, count, _, data = substrings._unpack(sent, "<u8", "u1", "<i8", "u1")
            contents.update({(s, c) for s, c in zip(sign.tolist(), substrings._content(count, data).tolist())} - contents.keys())
        return max(Counter(s for s, _ in contents).values())

    assert largest(1 << 30) > 250  # one entry a document
    assert largest(40) <= 40


def test_repeated_strings_edges(spark):
    text = "k" * 20 + "passage of more than fifty bytes that stands in several rows"
    docs = spark.createDataFrame([(3, text), (3, text), (None, text), (9, text), (10, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in substrings.repeated_strings(docs).collect()), key=str)
    assert got == sorted([(3, 0), (3, 0), (None, 0), (9, len(text)), (10, 0)], key=str)
    assert substrings.repeated_strings(docs.limit(0)).count() == 0


def test_repeated_strings_query_equals_sql(spark):
    same_as_sql(spark, "op6_repeated_strings")


# -- fingerprints ------------------------------------------------------------
def brute_phrases(text):
    seen, p = [], ""
    for c in text:
        p += c
        if p not in seen:
            seen.append(p)
            p = ""
    return seen


def test_phrases():
    for text in ("", "a", "aaaaaaa", "abracadabra abracadabra", "éß漢" * 9):
        assert lzprint.phrase_lengths(text, "", None)[0] == [len(p) for p in brute_phrases(text)]
    own, edited = lzprint.phrase_lengths("abcab", "cabca", "xyzab")
    assert own == [len(p) for p in brute_phrases("abcabcabca")] and edited == [len(p) for p in brute_phrases("abcabxyzab")]


def test_fingerprint_query(spark):
    rows = documents()
    got = {r.doc_id: r for r in queries.QUERIES["op7_lz_fingerprint"](spark, SF001).collect()}
    assert len(got) == len(rows)
    prints = [lzprint.fingerprint(t) for _, t in rows]

    def near(a, b):
        return sum(a[i:i + 4] == b[i:i + 4] for i in range(0, len(a), 4)) / lzprint.SLOTS

    for i, (d, t) in enumerate(rows):
        u = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (
            len(t), hashlib.sha256(e.encode()).hexdigest(), prints[i], lzprint.fingerprint(e))
        assert abs(r.near_next - near(prints[i], prints[(i + 1) % len(rows)])) < 1e-9
        assert abs(r.near_edited - near(prints[i], r.edited_fingerprint)) < 1e-9


def test_fingerprint_edges(spark):
    docs = spark.createDataFrame([(4, None), (1, ""), (None, "ab"), (9, "xy" * 9), (9, "xy" * 9)], "doc_id long, text string")
    got = lzprint.neighbour_likeness(docs.withColumn("key", F.lit("clash"))).collect()
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    assert by[1].near_next == 1.0 and by[None].near_next == 0.0 and by[4].near_next == 0.0
    one = lzprint.neighbour_likeness(docs.where("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert lzprint.neighbour_likeness(docs.limit(0)).count() == 0


# -- leaks -------------------------------------------------------------------
def brute_leaks(docs, items, threshold=0.8):
    out = {}
    prepared = [(i, len(words(t)), Counter(shingles(t))) for i, t in items]
    for d, t in docs:
        w, s = words(t), shingles(t)
        for i, n, own in prepared:
            if n < 5 or len(w) < 5 or not own.keys() & set(s):
                continue
            for at in range(max(1, len(w) - n + 1)):
                cut = Counter(s[at:at + n - 4])
                like = sum((cut & own).values()) / sum((cut | own).values())
                if like >= threshold:
                    out[d, i] = max(out.get((d, i), 0), round(like, 9))
    return out


def test_leaks_equal_brute_force(spark):
    items = duckdb.sql(f"select item_id, text from '{SF001}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.QUERIES["op8_decontamination"](spark, SF001).collect()}
    want = brute_leaks(documents(), items)
    assert got == want and want


def test_leak_edges(spark):
    item = "One two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([
        (1, f"before {item.upper()} after"), (2, None), (3, ""), (4, "one two three four"), (5, f"x {item[:-7]} y"),
        (6, "only Tiny item here"), (7, item), (7, item), (None, item), (8, "w " * 30000 + item)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, None), (3, "tiny ITEM"), (4, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontam.find_leaks(
        docs.withColumn("similarity", F.lit("clash")), items, block_items=1).collect()}
    assert got[1, 1] == (1.0, 1) and got[7, 1] == (1.0, 0) and got[8, 1] == (1.0, 30000) and got[6, 3] == (1.0, 1)
    assert set(got) - {(5, 1)} == {(1, 1), (7, 1), (8, 1), (None, 1), (6, 3)}
    left = decontam.decontaminate(docs, items).collect()
    assert sorted(str(r.doc_id) for r in left if r.doc_id != 5) == ["2", "3", "4", "None"]
    assert decontam.find_leaks(docs, items.limit(0)).count() == 0
    assert decontam.find_leaks(docs.limit(0), items).count() == 0


def test_hamming_index_reaches_as_far_as_its_blocks_allow():
    item = np.array([0x0123456789ABCDEF], dtype=np.uint64)
    for bits in (20, 21, 22, 23):  # at most 2 in some block, 3 in the others
        flips = sum(1 << (8 * (k % 8) + k // 8) for k in range(bits))
        window, _, distance = decontam.SizeIndex(item).within(item ^ np.uint64(flips))
        assert window.tolist() == [0] and distance.tolist() == [bits]


def test_hamming_index_finds_all_within_radius():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 24), replace=False)) for _ in range(400)], dtype=np.uint64)
    asked = prints[rng.integers(0, 50, 400)] ^ flips
    window, item, distance = decontam.SizeIndex(prints).within(asked)
    every = np.bitwise_count(asked[:, None] ^ prints[None, :])
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(every <= decontam.RADIUS))))
    assert (every[window, item] == distance).all()


# -- near duplicates ---------------------------------------------------------
def brute_components(rows, percent):
    sets = {d: set(shingles(t)) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}


def test_near_duplicates_of_chains_and_copies(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows, d = [], 0
    for _ in range(3):  # chains: each text differs a little from the one before
        w = rng.sample(base, 60)
        for _ in range(25):
            rows.append((d * 7 % 997, " ".join(w)))
            d += 1
            w = w[1:] + [rng.choice(base)]
    rows += [(2000 + i, "Same  text of SIX words here") for i in range(20)] + [(3000, None), (3001, ""), (3002, "one two"), (3003, "ONE two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash"))
    want = brute_components(rows, 85)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert all(r.kept == (want[k] == k) for k, r in got.items())
    assert neardup.near_duplicates(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in neardup.drop_near_duplicates(docs, 85).collect()) == sorted(k for k in want if want[k] == k)


def test_divided_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 2)
    head = [f"h{i}" for i in range(40)]
    # y and z link with each other only; the hub of a shared bucket links with neither
    rows = [(1, " ".join(head[:20] + [f"a{i}" for i in range(20)])), (2, " ".join(head)), (3, " ".join(head[:39] + ["z"])), (4, " ".join(head[:20] + [f"b{i}" for i in range(20)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members = spark.createDataFrame([(5, d, 1, 36) for d in (1, 2, 3, 4)], "bucket long, rep long, hub long, n_shingles long")
    component = spark.createDataFrame([(d, d) for d in (1, 2, 3, 4)], "vertex long, component long")
    got = {tuple(sorted(r)) for r in neardup._rest_links(members, component, docs, 80).collect()}
    assert got == {(2, 3)}


def test_near_duplicate_query_equals_sql(spark):
    same_as_sql(spark, "op9_minhash_neardup")


# -- pipeline ----------------------------------------------------------------
def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF001)
        assert kept.columns == docs.columns
    got = {r.doc_id: r for r in kept.collect()}
    # kept documents: brute force of the two pair stages, masked texts
    want = brute_components([(d, r.text) for d, r in rows.items()], 80)
    items = duckdb.sql(f"select item_id, text from '{SF001}/benchmark.parquet'").fetchall()
    leaks = {d for d, _ in brute_leaks([(d, r.text) for d, r in rows.items()], items)}
    assert set(got) == {d for d in rows if want[d] == d and d not in leaks}
    from rankwright.llm import packing, pii
    assert all(r.text == pii.redact_text(rows[d].text) and r.n_chars == len(r.text) for d, r in got.items())
    out = corpus_pipeline.run(spark, SF001).collect()
    assert sum(r["size"] for r in out) == sum(r.n_chars for r in got.values())
    assert {r.doc_id for r in out} == set(got) and all(r.bin_used <= packing.CAPACITY for r in out)


def test_stages_take_odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns, no rows."""
    import corpus_pipeline
    schema = "doc_id long, text string, lang string, source string, n_chars long, _language string, shard int, kept string"
    prose = [f"the small brown fox number {i} walks over the old bridge and then goes home again at {i * 7} o clock" for i in range(30)]
    rows = [(i, t, "en", "s", len(t), "x", 1, "k") for i, t in enumerate(prose)]
    rows += [(100, None, None, None, None, None, None, None), (101, "", "en", None, 0, None, None, None), (None, "a text without an id stays here", "en", "s", 5, "x", 1, "k"),
             (102, "word " * 50000, "en", "s", 1, "x", 1, "k"), (3, prose[3], "en", "s", 1, "x", 1, "k"), (3, prose[3], "en", "s", 1, "x", 1, "k")]
    docs = spark.createDataFrame(rows, schema)
    for frame, empty in ((docs, False), (docs.limit(0), True)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SF001)
            assert frame.columns == docs.columns
        got = frame.collect()
        packed = corpus_pipeline.STAGES[-1][1](spark, frame, SF001).collect()
        if empty:
            assert not got and not packed
        else:
            ids = [r.doc_id for r in got]
            assert {100, 101}.isdisjoint(ids) and set(range(30)) <= set(ids) and None in ids and 102 in ids and ids.count(3) == 3
            assert sum(r["size"] for r in packed) == sum(len(r.text) for r in got)
