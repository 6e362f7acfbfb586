"""Passes over the texts of a field index: blocks of queries, chunks of documents, copies of a query."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from rankwright.functions.expressions import Feature
from rankwright.operators import features as FT
from rankwright.operators import field_index as X
from rankwright.operators import field_scan as S

WORDS = ["red", "reds", "fox", "foxes", "hen", "singing", "sing", "owl"]
DOCS = "lang string, doc_id bigint, title string, text string"


def rows_of(n=50, seed=4):
    rng = random.Random(seed)
    rows = [("en" if i % 3 else "fr", i, " ".join(rng.choices(WORDS, k=rng.randint(1, 4))), " ".join(rng.choices(WORDS, k=rng.randint(0, 20))) or None) for i in range(n)]
    # ids of several rows, equal and not; no language; no id
    return rows + [rows[1], ("en", 2, "owl", "red fox"), (None, 100, "red fox", "hen"), ("en", None, "red fox", "hen hen")]


QUERIES = [(1, "red fox"), (2, "Red, FOX"), (3, "hen"), (4, "singing owl red"), (5, "owl"), (5, "hen hen"), (6, "zebra"), (7, None), (None, "red fox"), (8, "fox fox")]
FEATURES = [Feature("m", "match", "title"), Feature("p", "phrase", "text_plain"), Feature("s", "explorer", "text", {"agg": "stddev", "stat": "raw_ttf"}),
            Feature("d", "derived", None, {"expression": "m + p"})]


def all_of(spark, joined=None):
    docs = spark.createDataFrame(rows_of(), DOCS).selectExpr("*", "concat_ws(' \\n ', title, text) AS all", "title AS all_near_match")
    queries = spark.createDataFrame(QUERIES, "item_id bigint, text string")
    fields = ["title", "text", "all", "all_near_match"]
    out = {}
    with X.build(docs, fields, ["title", "text_plain", "all"], joined=joined) as index:
        top = X.full_search(queries, index, 3, ((("title", 0.3),), (("text", 0.6), ("title", 0.1))))
        out["parts"] = index._known[0].parts
        out["top"] = Counter((r.lang, r.item_id, r.doc_id, round(r.score, 8), r["rank"]) for r in top.collect())
        out["phrases"] = Counter(tuple(r) for r in X.phrase_counts(queries, index, ["title", "text_plain", "all"]).collect())
        pairs = index.docs.select("lang", "doc_id").crossJoin(queries.select("item_id")).distinct()
        out["scores"] = Counter((*r[:4], round(r.score, 8), r.matched, r.n_terms) for r in X.match_scores(queries, index, ["title", "all_plain"], pairs).collect())
        out["held"] = Counter(tuple(r) for r in X.all_terms(queries, index, ["all"]).collect())
        out["stats"] = Counter((*r[:3], *[round(v, 8) for v in r[3:]]) for r in X.term_statistics(queries, index, ["title", "text"], pairs).collect())
        rows = FT.collect_field_features(pairs.where("doc_id < 20"), queries, index, FEATURES, index.docs)
        out["features"] = Counter((r.lang, r.item_id, r.doc_id, round(r.m, 8), r.p, round(r.s, 8), round(r.d, 8)) for r in rows.select(*X.KEY, "m", "p", "s", "d").collect())
    return out


def test_blocks_of_queries_give_what_one_gives(spark, monkeypatch):
    whole = all_of(spark)
    assert whole["parts"] == 1 and all(whole[k] for k in ("top", "phrases", "scores", "held", "stats", "features"))
    monkeypatch.setattr(X, "BLOCK_TERMS", 3)
    parted = all_of(spark, {"all": ("title", "text"), "all_near_match": ("title",)})
    assert parted.pop("parts") > 2
    assert parted == {k: whole[k] for k in parted}


def test_ids_of_several_rows_are_dealt_or_sent(spark, monkeypatch):
    """Whether few ids of several rows are sent to every task or all rows are dealt, their rows are one document."""
    whole = all_of(spark)
    monkeypatch.setattr(X, "SENT_IDS", 0)
    assert all_of(spark) == whole


def test_searches_of_the_same_words_are_sought_once(spark):
    docs = spark.createDataFrame([("en", i, "red fox", "hen") for i in range(40)], DOCS).selectExpr("*", "title AS all", "title AS all_near_match")
    queries = spark.createDataFrame([(i, "red fox" if i % 2 else "Red fox!") for i in range(30)], "item_id bigint, text string")
    with X.build(docs, ["title", "text", "all", "all_near_match"]) as index:
        top = X.full_search(queries, index, 5, ((("title", 0.3),),)).collect()
        assert index._known[0].blocks[0].items.to_pylist() == [0]
        # no posting is stored for it
        assert "postings" not in index.__dict__ and "terms" not in index.__dict__
    assert len(top) == 150 and {(r.doc_id, r["rank"]) for r in top if r.item_id == 29} == {(i, i + 1) for i in range(5)}


def batches_of(rows, columns=("title", "text")):
    rows = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0))
    return pa.table({"lang": pa.array([r[0] for r in rows], pa.string()), "doc_id": pa.array([r[1] for r in rows], pa.int64()),
                     "title": [r[2] for r in rows], "text": [r[3] or "" for r in rows]}).to_batches(max_chunksize=7)


def counts_of(rows):
    texts = S.Texts(X.with_variants(["title", "text"]), {})
    found = Counter()
    for batch in S.task_counts(texts, None, iter(batches_of(rows))):
        for r in batch.to_pylist():
            found[r["lang"], r["field"], r["term"], "df"] += r["df"]
            found[r["lang"], r["field"], r["term"], "ttf"] += r["ttf"]
    return found


def test_counts_hold_a_chunk_at_a_time(monkeypatch):
    whole = counts_of(rows_of())
    sizes = []
    monkeypatch.setattr(S, "CHUNK_BYTES", 100)
    real = S.Chunk.__init__
    monkeypatch.setattr(S.Chunk, "__init__", lambda self, rows, texts: (sizes.append(rows.num_rows), real(self, rows, texts))[1])
    assert counts_of(rows_of()) == whole
    assert len(sizes) > 5 and max(sizes) < 20
    # the two rows of document 1 are one document with its words twice; an id's rows of other lengths are counted each
    title = rows_of()[1][2].split()
    alone = counts_of([rows_of()[1], rows_of()[1]])
    assert all(alone["en", "title_plain", w, "df"] == 1 and alone["en", "title_plain", w, "ttf"] == 2 * title.count(w) for w in title)


def test_chunks_do_not_part_an_id(monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", 10)
    rows = [("en", i // 4, "red fox", "hen") for i in range(40)]
    found = [t["doc_id"].to_pylist() for t in S.chunks(iter(batches_of(rows)), ("title", "text"))]
    assert sum(found, []) == [r[1] for r in rows] and all(len(set(f)) * 4 == len(f) for f in found)


def test_phrases_in_slices_equal_a_scan(monkeypatch):
    rng = random.Random(2)
    rows = [("en", i, "x", " ".join(rng.choices("ab", k=rng.randint(0, 12)))) for i in range(60)]
    asked = ["a", "a b", "a a", "b a b", "a a a", "b b"]
    block = S.Block.of(pa.table({"item_id": list(range(len(asked))), "words": asked}), 1.2, 0.75)
    block.langs = pa.array(["en"])
    texts, known = S.Texts(("text_plain",), {}), []
    sent = type("Sent", (), {})()
    sent.value = block.vocab
    for batch in S.task_counts(texts, sent, iter(batches_of(rows))):
        known.append(pa.Table.from_batches([batch]))
    block.learn(["text_plain"], lambda name: pa.concat_tables(known))
    block.seek(["text_plain"])
    sent.value = block
    monkeypatch.setattr(S, "SLICE", 7)
    got = {(r["of"], r["doc_id"]): r["phrase_freq"] for b in S.task_phrases(texts, sent, ("text_plain",), iter(batches_of(rows))) for r in b.to_pylist()}

    def count(words, phrase):
        n = i = 0
        while i + len(phrase) <= len(words):
            n, i = (n + 1, i + len(phrase)) if words[i:i + len(phrase)] == phrase else (n, i + 1)
        return n

    want = {(j, r[1]): count(r[3].split(), q.split()) for r in rows for j, q in enumerate(asked)}
    assert got == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("word", ["sings", "sing", "singing", "boxes", "bees", "été", "étées", "ings"])
def test_stems_are_those_of_spark(spark, word):
    from pyspark.sql import functions as F
    want = spark.createDataFrame([(word,)], "t string").select(X.analysed(F.col("t"), "stem").alias("s")).first().s
    assert S.stemmed(pa.array([word])).to_pylist() == want
