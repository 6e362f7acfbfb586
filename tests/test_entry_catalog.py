import math

import pytest

import __spark_entry__ as entry_mod
from rankwright.operators import retrieval as R
from tests.conftest import SF001


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["wikiid", "ndcg"]
    assert len(rows) == 5 and all(0 <= r.ndcg <= 1 for r in rows)


def test_oracle_keys_are_queries():
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 55
    assert not any(k.startswith("op") for k in entry_mod.catalog.QUERIES)


@pytest.mark.parametrize("key", ["ndcg_weighted", "session_hits", "query_jaccard", "match_score",
                                 "feature_mi", "update_results", "counter_ema"])
def test_against_duckdb(spark, key):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    from rankwright.sources.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = entry_mod.queries()[key](spark, SF001)
    res = con.execute(entry_mod.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(cols)
    order = sorted(cols)

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    a = sorted((tuple(norm(r[c]) for c in order) for r in got.collect()), key=repr)
    b = sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in res.fetchall()), key=repr)
    assert a == b


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([(1, "en", "the cat sat"), (2, "en", "the dog"), (3, "en", "cats and dogs")],
                                 "doc_id long, lang string, text string")
    q = spark.createDataFrame([(7, "cat")], "item_id long, text string")
    got = {r.doc_id: r.score for r in R.match_score(q, docs, "text_plain").collect()}
    n, df_, avg = 3, 1, (3 + 2 + 3) / 3
    idf = math.log(1 + (n - df_ + 0.5) / (df_ + 0.5))
    want = idf * 1 * 2.2 / (1 + 1.2 * (1 - 0.75 + 0.75 * 3 / avg))
    assert got == {1: pytest.approx(want)}


def test_phrase_counts_back_to_back(spark):
    docs = spark.createDataFrame([(1, "en", "a b a b x"), (2, "en", "xa b"), (3, "en", "b a")],
                                 "doc_id long, lang string, text string")
    q = spark.createDataFrame([(7, "A, b!")], "item_id long, text string")
    got = {r.doc_id: r.phrase_freq for r in R.phrase_match(q, docs).collect()}
    assert got == {1: 2}


def test_matches_move_only_texts(spark):
    """Whole texts are dealt by document once; nothing that was taken apart is shuffled again, and token lists end at the explode."""
    docs = spark.createDataFrame([(1, "en", "a b a b x"), (2, "en", "xa b"), (3, "de", "b a")], "doc_id long, lang string, text string")
    q = spark.createDataFrame([(7, "A, b!")], "item_id long, text string")
    rows = R.postings(docs, ["text", "text_plain"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("split(lower(text") == 1
    for line in plan.splitlines():
        if "Generate explode" in line:
            assert "_t#" not in line.split("),", 1)[1]
    assert R.match_scores(q, docs, ["text", "text_plain"]).count() == 3


def test_postings_of_repeated_documents(spark):
    """Rows of one key and length count as one document, as in the SQL; null and empty texts have no terms."""
    docs = spark.createDataFrame([(1, "en", "cats sing"), (1, "en", "cats sing"), (2, "en", None), (3, "en", ""), (4, None, "cats")],
                                 "doc_id long, lang string, text string")
    got = {(r.lang, r.field, r.term): (r.df, r.ttf) for r in R.term_stats(docs).collect()}
    assert got[("en", "text_plain", "cats")] == (1, 2) and got[("en", "text", "cats")] == (1, 2)
    assert got[(None, "text_plain", "cats")] == (1, 1) and len(got) == 6
    assert {(r.term, r.tf, r.dl) for r in R.doc_terms(docs, "text").where("doc_id = 1").collect()} == {("cats", 2, 2), ("sing", 2, 2)}


def test_postings_of_queries_are_made_once(spark, monkeypatch):
    """Scores, terms, search and phrases read one stored set of a query set's postings; texts are cut into tokens once a job."""
    docs = spark.createDataFrame([(1, "en", "A-b  a,b x"), (2, "en", "xa b"), (3, "de", "b a"), (3, "de", "b a a b"), (4, "en", None), (5, "en", ""),
                                  (6, None, "a b"), (None, "en", "cats, b"), (None, "en", "cat! b")], "doc_id long, lang string, text string")
    q = spark.createDataFrame([(7, "A, b!"), (8, "cats")], "item_id long, text string")
    made, own = [], R.postings
    monkeypatch.setattr(R, "postings", lambda *a, **k: made.append(a) or own(*a, **k))
    idx = R.build_index(docs, ["text_plain"])
    assert {(r.lang, r.n_docs, r.avg_dl) for r in idx.stats.collect()} == {("en", 6, 2.2), ("de", 2, 3.0), (None, 1, 2.0)}
    scores = R.match_score(q, idx, "text_plain")
    found = {(r.lang, r.item_id, r.doc_id, r.matched_terms) for r in scores.collect()}
    # the two rows without an id are of one length, so they are one document
    assert found == {("en", 7, 1, 2), ("en", 7, 2, 1), ("de", 7, 3, 4), ("en", 7, None, 1), ("en", 8, None, 1)}
    terms = R.explore_terms(q, idx, scores.select("lang", "item_id"), "text_plain", stats=["raw_df", "raw_ttf"], aggs=["sum"])
    assert {(r.lang, r.item_id, r.sum_raw_df, r.sum_raw_ttf) for r in terms.collect()} == {
        ("en", 7, 4.0, 7.0), ("de", 7, 4.0, 6.0), ("en", 8, 1.0, 1.0)}
    assert {(r.doc_id, r.phrase_freq) for r in R.phrase_match(q.where("item_id = 7"), idx).collect()} == {(1, 2), (3, 1)}
    assert len(made) == 2  # one a set of queries
    R.search(q, idx, weights={"text_plain": 1.0}), R.match_scores(q, idx, ["text_plain"], pairs=scores)
    assert len(made) == 2
    idx.unpersist()


def test_texts_are_dealt_once_a_job(spark):
    """All features of an index read one stored deal of the texts, statistics of a set of queries are made once, and no list of
    tokens is aggregated."""
    docs = spark.createDataFrame([(1, "en", "a b a b x"), (2, "en", "xa b"), (3, "de", "b a"), (3, "de", "b a a b")],
                                 "doc_id long, lang string, text string")
    q = spark.createDataFrame([(7, "A, b!")], "item_id long, text string")
    idx = R.build_index(docs)
    for rows in (R.match_score(q, idx), R.phrase_match(q, idx), R.search(q, idx), R.term_stats(idx)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        outside = "\n".join(x for x in plan.split("InMemoryRelation")[:1] + [y for x in plan.split("InMemoryRelation")[1:] for y in x.splitlines()[:1]])
        assert "InMemoryRelation" in plan and "RepartitionByExpression" not in outside and "flatten(" not in plan
    assert idx.asked(q, ["text"], "item_id", "text") is idx.asked(q, ["text"], "item_id", "text")
    every = {(r.lang, r.item_id, r.doc_id, r.phrase_freq) for r in R.phrase_match(q, idx).collect()}
    assert every == {("en", 7, 1, 2), ("de", 7, 3, 1)}
    pairs = spark.createDataFrame([("de", 7, 3), ("en", 7, 2)], "lang string, item_id long, doc_id long")
    assert {(r.lang, r.doc_id, r.phrase_freq) for r in R.phrase_match(q, idx, pairs=pairs).collect()} == {("de", 3, 1)}
    idx.unpersist()
    assert idx._cached == []
