"""Tokenizer alignment, collocations and certified quality rules."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankwright.llm import alignment, automata, mph, phrases, quality, queries

SF001 = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  b", "a\nb", "a \n b", "x\n\n\ty", "don't stop", "l'été déjà vu", "naïve café ☕ 漢字かな",
       "<s> [INST] </s> <|endoftext|> <unk>", "▁low line ▁", "a▁b c", "tab\tand\rreturn\x0b.", " nbsp x", "emoji 👩‍👩‍👧 ok", "0x1F 3.14159 1,000,000",
       "é é combining", "a" * 300, "﻿bom", "semi; \rcolon", "; \n;\n ;", "　wide　space", "a ́b", "\x1c\x1d sep", "…—“quotes”"]


def documents(columns="doc_id, text"):
    return duckdb.sql(f"select {columns} from '{SF001}/documents.parquet' order by doc_id").fetchall()


# -- cross-tokenizer alignment ---------------------------------------------------
def brute_alignment(rows):
    """Every text encoded whole; links by testing every pair of byte ranges."""
    aligner = alignment.Aligner(*alignment.default_tokenizers())
    found, held = [], Counter()
    for doc_id, text in rows:
        data = (" " + (text or "")).encode()
        a = aligner.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = aligner.b.encode(text) if text else []
        parts = [[aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]]
        if not text or any(b"".join(p) != data for p in parts):
            found.append((doc_id, [], [], [], []))
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        spans = [list(zip([0, *e[:-1]], e)) for e in ends]
        links = [(x, y) for x, (s, e) in zip(a, spans[0]) for y, (t, f) in zip(b, spans[1]) if s < f and t < e]
        groups, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            now = [e.index(end) + 1 for e in ends]
            groups.append(",".join(map(str, a[at[0]:now[0]])) + "|" + ",".join(map(str, b[at[1]:now[1]])))
            at = now
        held.update(set(links))
        found.append((doc_id, a, b, links, groups))
    high: dict = {}
    for (x, _), c in held.items():
        high[x] = max(high.get(x, 0), c)
    return sorted((d, len(a), len(b), len(g), len(k), sum(held[p] == high[p[0]] for p in k), sum(held[p] for p in k),
                   hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, k, g in found)


def aligned(spark, rows, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted(tuple(r) for r in alignment.align_corpus(docs, **kwargs).collect())


def test_alignment_equals_whole_text_encoding(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choices(ODD + ["the", " ", "and", " of ", "\n"], k=rng.randint(1, 9))) for _ in range(150)]
    rows = [*enumerate(texts), (900, None), (901, "the same"), (902, "the same")]
    # many shards, slices and tree levels, and one shard
    assert aligned(spark, rows, shard_bytes=400, slices=5, fan_in=2) == brute_alignment(rows)
    assert aligned(spark, rows) == brute_alignment(rows)


def test_alignment_query_equals_brute_force(spark):
    got = sorted(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
                 for r in queries.QUERIES["op11_cross_tokenizer"](spark, SF001).collect())
    assert got == brute_alignment(documents())


def test_alignment_of_odd_tables(spark):
    assert aligned(spark, []) == []
    rows = [(None, "a b"), (None, "a b"), (5, "a b"), (5, "c"), (None, None)]
    got = aligned(spark, [r for r in rows if r[0] is not None])
    assert [r[0] for r in got] == [5, 5] and got == brute_alignment([r for r in rows if r[0] is not None])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("shard", F.lit("x")).withColumn("keys", F.lit(1))
    sums = [r["count_sum"] for r in alignment.align_corpus(docs).where("n_a = 2").collect()]
    assert sums == [6, 6, 6]  # two links, each in three documents


def test_perfect_hash_is_minimal_and_round_trips():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 20000):
        keys = np.unique(rng.integers(0, 1 << 33, n, dtype=np.uint64))
        hashed = mph.PerfectHash.from_bytes(mph.PerfectHash.build(keys).to_bytes())
        assert sorted(hashed.numbers(keys).tolist()) == list(range(len(keys))) and hashed.size == len(keys)
    table = np.empty(len(keys), np.uint64)
    table[hashed.numbers(keys)] = keys
    with pytest.raises(ValueError):
        alignment.verified(hashed, table, np.array([keys[0] + np.uint64(1 << 40)]))


# -- quality rules ---------------------------------------------------------------
def same_as_sql(spark, key, folder=SF001, tables=("documents", "labels")):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    res = con.execute(queries.ORACLE[key])
    names = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=str)
    got = sorted((tuple(r[n] for n in names) for r in queries.QUERIES[key](spark, folder).collect()), key=str)
    assert got == want


def test_quality_query_equals_sql(spark):
    same_as_sql(spark, "op13_quality_rules")


def exact_cdf(k, n, rate):
    p = Fraction(rate)
    return float(sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_binomial_bound_is_exact(spark):
    cases = [(k, n) for n in (1, 7, 60, 400, 1500) for k in (0, 1, 2, 5, 11, 14) if k < n * 0.01]
    rows = spark.createDataFrame(cases, "k bigint, n bigint").select("k", "n", quality.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p"))
    for r in rows.collect():
        assert r.p == pytest.approx(exact_cdf(r.k, r.n, 0.01), rel=1e-9)
    far = spark.createDataFrame([(990_000, 100_000_000)], "k bigint, n bigint")
    got = far.select(quality.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p")).first().p
    assert got == pytest.approx(0.5 * math.erfc((1_000_000 - 990_000.5) / math.sqrt(2 * 990_000)), rel=0.02)


def repeated(words, width=8):
    seen = Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1))
    inside = {j for i in range(len(words) - width + 1) if seen[tuple(words[i:i + width])] > 1 for j in range(i, i + width)}
    return len(inside)


def test_repeated_words_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(120)] + ["x " * 30, "", " \n", "a b c d e f g h", "a b c d e f g h i " * 2]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.n for r in rows.select("doc_id", quality.repeated_words(quality.words(F.col("text"))).alias("n")).collect()}
    assert got == {i: repeated(t.split()) for i, t in enumerate(texts)}


def labelled(spark, good, bad, spoiled=0, lang="en"):
    """Good plain texts (``spoiled`` of them full of symbols) and bad ones full of symbols."""
    plain = " ".join(f"word{i}" for i in range(30))
    noisy = " ".join(f"word{i}$$$" for i in range(30))
    rows = [(i, noisy if i < spoiled else plain, lang) for i in range(good)] + [(10_000 + i, noisy, lang) for i in range(bad)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return docs, docs.select("doc_id", (F.col("doc_id") < 10_000).cast("int").alias("quality"))


def chosen(spark, *args, **kwargs):
    docs, labels = labelled(spark, *args)
    found = quality.thresholds(quality.measure(docs), labels, **kwargs).where("chosen").collect()
    return {(r.stratum, r.rule): r.cutoff for r in found}


def test_cutoffs_need_enough_good_documents(spark):
    rule = (quality.Rule("symbols", quality.RULES[0].measure, (4000, 2500, 1000)),)
    # one rule, one stratum: (1 - 0.05) ** n <= 0.05 from n = 59 on
    assert chosen(spark, 59, 5, rules=rule) == {("en", "symbols"): 2500}
    assert chosen(spark, 58, 5, rules=rule) == {}
    # false rejections on the holdout: the bound must hold with them
    need = next(n for n in range(59, 200) if exact_cdf(2, n, 0.05) <= 0.05)
    assert chosen(spark, need, 5, 2, rules=rule) == {("en", "symbols"): 2500}
    assert chosen(spark, need - 1, 5, 2, rules=rule) == {}
    # more rules: alpha and delta are divided
    assert chosen(spark, 120, 5) == {}


def test_false_rejections_stay_within_the_limit(spark):
    """Over many draws the true risk of the chosen cutoff exceeds alpha no more often than delta."""
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for draw in range(60):  # strata are draws; the level is uniform on 0..99 for good, high for bad documents
        levels = rng.integers(0, 100, 150).tolist() + rng.integers(50, 100, 20).tolist()
        for i, level in enumerate(levels):
            rows.append((draw * 1000 + i, f"s{draw}", level))
            labels.append((draw * 1000 + i, int(i < 150)))
    measured = spark.createDataFrame(rows, "doc_id bigint, stratum string, level bigint")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    picks = quality.thresholds(measured, known, (quality.Rule("r", "level", (97, 95, 93, 91, 89, 87, 85, 80)),), alpha=0.1, delta=0.1) \
        .where("chosen").collect()
    over = sum((99 - r.cutoff) / 100 > 0.1 for r in picks)
    assert len(picks) > 30 and over <= 6


def test_rules_that_gain_nothing_stay_off_and_strata_are_apart(spark):
    docs, labels = labelled(spark, 900, 40)
    other, other_labels = labelled(spark, 30, 10, 0, None)
    both = docs.unionByName(other.withColumn("doc_id", F.col("doc_id") + 50_000))
    marks = labels.unionByName(other_labels.withColumn("doc_id", F.col("doc_id") + 50_000))
    extra = both.withColumn("stratum", F.lit("zz")).withColumn("kept", F.lit(7)).withColumn("w", F.lit(1)).withColumn("level", F.lit(2))
    got = quality.quality_report(extra, marks).groupBy("stratum", (F.col("doc_id") % 50_000 >= 10_000).alias("bad")) \
        .agg(F.min(F.col("kept").cast("int")).alias("lo"), F.max(F.col("kept").cast("int")).alias("hi")).collect()
    # und has too few good labels: its rules are off
    assert {(r.stratum, r.bad): (r.lo, r.hi) for r in got} == {
        ("en", False): (1, 1), ("en", True): (0, 0), ("und", False): (1, 1), ("und", True): (1, 1)}


def test_quality_of_odd_rows(spark):
    rows = [(1, None, None), (None, "", "en"), (2, "#*$%&|<> a\n\na\na", "en"), (2, "word " * 40, None), (3, " ".join(map(str, range(20))), "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = {(r.doc_id, r.stratum): (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
           for r in quality.quality_report(docs, none).collect()}
    assert got == {(1, "und"): (0, 0, 0, 0, 0, True, False), (None, "en"): (0, 0, 0, 0, 0, True, False),
                   (2, "en"): (4, 11, 8, 1, 0, True, False), (2, "und"): (40, 160, 0, 0, 40, True, False),
                   (3, "x"): (20, 30, 0, 0, 0, False, True)}
    assert quality.quality_report(docs.limit(0), none).collect() == []


def test_quality_runs_no_python_on_executors(spark):
    docs, labels = labelled(spark, 5, 2)
    plan = quality.quality_report(docs, labels)._jdf.queryExecution().toString() + quality.measure(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


# -- collocations -----------------------------------------------------------------
def brute_phrases(rows, least, top=2000):
    total, counts = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            counts.update((lang, tuple(w[i:i + n])) for n in range(1, 5) for i in range(len(w) - n + 1))
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longest: Counter = Counter()
    for (lang, w), a in found.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                longest[lang, w[i:i + n]] = max(longest[lang, w[i:i + n]], a)
    out = []
    for (lang, w), a in found.items():
        if 100 * longest[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], total[lang], score))
    best = []
    for lang in total:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        best += [(r[0], i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(best)


def mined(spark, rows, parts=3, **kwargs):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in phrases.mine(docs, **kwargs).collect())


def test_collocations_equal_brute_force(spark):
    rng = random.Random(6)
    alphabet = ["the", "of", "The", "a", "été", "\x01x", "z ", " ", "\t", ".", ", ", "\n", "\r", "\x0b", "漢字", "<s>", "á", "new york city", "it's"]
    rows = [(" ".join(rng.choices(alphabet, k=rng.randint(0, 40))), rng.choice(["en", "fr", None, "", "e\nn"])) for _ in range(160)]
    rows += [(None, "en"), ("", None), ("one two three four five " * 9, "en"), ("x" * 70000 + " y " * 50, "zz")]
    for kwargs in ({"shard_bytes": 300, "ranges": 7}, {"ranges": 1}, {"top": 5, "ranges": 3}):
        assert mined(spark, rows, least=3, **kwargs) == brute_phrases(rows, 3, kwargs.get("top", 2000))


def test_hot_phrase_in_many_shards(spark):
    rows = [("hot phrase here " * 20, "en")] * 60 + [(f"w{i} w{i + 1} hot phrase", "en") for i in range(60)]
    assert mined(spark, rows, parts=6, shard_bytes=500, ranges=11) == brute_phrases(rows, 30)


def test_collocations_of_empty_tables_and_extra_columns(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), ("", "en")]) == []
    docs = spark.createDataFrame([("a b", "en")] * 31, "text string, lang string") \
        .withColumn("shard", F.lit("q")).withColumn("n", F.lit(0)).withColumn("phrase", F.lit("p")).withColumn("rank", F.lit(1))
    assert [tuple(r) for r in phrases.mine(docs).collect()] == [("en", 1, "a b", 31, 31, 31, 62, 1_000_000)]


def test_scores_pass_64_bits(spark):
    huge = 9_000_000_000_000_000
    rows = spark.createDataFrame([("en", "a b", huge, [(huge, huge + 2)])], "lang string, phrase string, a bigint, cuts array<struct<l:bigint,r:bigint>>")
    assert phrases.scored(rows).first().score == 2_000_000 * huge // (2 * huge + 2)


def test_collocations_query_equals_sql(spark):
    same_as_sql(spark, "op12_collocations", "/root/testdata/sf0.01", ("documents",))


def test_automaton_round_trip_union_and_composition():
    rng = np.random.default_rng(4)
    words = pa.array(sorted({f"w{i}".encode() for i in range(40)}), pa.binary())
    for depth in (2, 3, 5):
        made, want = [], Counter()
        for _ in range(4):
            rows, number = automata.distinct(rng.integers(0, 40 if depth > 2 else 12, (300, depth)))
            counts = np.bincount(number)
            a = automata.Automaton.from_bytes(automata.Automaton.build(words, rows, counts).to_bytes())
            back, n = a.paths()
            names = [[a.words[int(x)].as_py() for x in r] for r in back]
            assert names == [[words[int(x)].as_py() for x in r] for r in rows] and n.tolist() == counts.tolist()
            want.update({tuple(k): int(c) for k, c in zip(names, n)})
            made.append(a)
        whole = automata.united(made, 2)
        back, n = whole.paths()
        got = {tuple(whole.words[int(x)].as_py() for x in r): int(c) for r, c in zip(back, n)}
        assert got == {k: c for k, c in want.items() if c > 1}
        first = [tuple(made[0].words[int(x)].as_py() for x in r) for r in made[0].paths()[0]]
        assert whole.compose(made[0]).tolist() == [got.get(k, 0) for k in first]


def test_equal_states_of_an_automaton_are_one():
    words = pa.array([b"a", b"b", b"c", b"d"], pa.binary())
    rows = np.array([[0, x, y] for x in (0, 1, 2) for y in (1, 3)])
    a = automata.Automaton.build(words, rows, np.ones(6, np.int64))
    assert len(a.source) == 6  # root to a, three arcs to one shared state, its two arcs
    assert len(automata.Automaton.build(words, rows, np.arange(6)).source) == 10
    one = automata.Automaton.build(words, rows[:0], np.zeros(0, np.int64))
    assert one.paths()[0].shape == (0, 3) and a.compose(automata.Automaton.from_bytes(one.to_bytes())).tolist() == []


# -- personal data: context decides -----------------------------------------------
def test_context_words_decide_on_weak_kinds(spark):
    from rankwright.llm import pii
    texts = {"My social security number is 219-09-9999, keep it.": True, "Part 219-09-9999 is sold out.": False,
             "Example social security number: 219-09-9999": False, "SSN 000-12-3456": False, "ssn 219-09-99991": False,
             "ssn " + "x" * 60 + " 219-09-9999": False, "219-09-9999 (taxpayer)": True}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(90, None), (91, "")], "doc_id bigint, text string") \
        .withColumn("spans", F.lit("clash")).withColumn("score", F.lit(1))
    got = {r.doc_id: [s["kind"] for s in r.spans] for r in pii.pii_report(docs).collect()}
    assert got == {i: ["ssn"] if want else [] for i, want in enumerate(texts.values())} | {90: [], 91: []}
    # without a limit the same spans are there: it is the context that leaves them out
    assert [k for k, *_ in pii.spans_of("Part 219-09-9999 is sold out.", 0.0)] == ["ssn"]
    assert pii.redact_text("social security 219-09-9999") == "social security <SSN>"
    assert pii.redact_text("Part 219-09-9999") == "Part 219-09-9999"
