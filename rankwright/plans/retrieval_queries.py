"""Registered queries: index statistics, match features, search, rescoring.

Queries are the whole texts of ``benchmark``; documents are ``documents``
with ``lang`` as the wiki.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval as R
from ..sources.tables import table
from .registry import register, rnd

TOP_N = 20
ROUTER_LIMIT = 40

# ---------------------------------------------------------------- SQL pieces
TOK = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) > 0)"
STEM = ("list_transform(toks, lambda x: CASE WHEN length(x) > 4 "
        "THEN regexp_replace(x, '(ing|es|s)$', '') ELSE x END)")

BASE_SQL = f"""
dplain AS (SELECT doc_id, lang, {TOK} AS toks FROM documents),
dstem AS (SELECT doc_id, lang, {STEM} AS toks FROM dplain),
qplain AS (SELECT item_id, {TOK} AS toks FROM benchmark),
qstem AS (SELECT item_id, {STEM} AS toks FROM qplain)"""


def _field_sql(f: str, src: str, q: str) -> str:
    return f"""
post_{f} AS (SELECT lang, doc_id, term, CAST(dl AS INTEGER) AS dl, count(*) AS tf
             FROM (SELECT lang, doc_id, len(toks) AS dl, unnest(toks) AS term FROM {src})
             GROUP BY lang, doc_id, term, dl),
fs_{f} AS (SELECT lang, count(*) AS n_docs, avg(len(toks)) AS avg_dl FROM {src} GROUP BY lang),
df_{f} AS (SELECT lang, term, count(*) AS df, sum(tf) AS ttf FROM post_{f} GROUP BY lang, term),
qt_{f} AS (SELECT item_id, CAST(len(list_distinct(toks)) AS INTEGER) AS n_terms,
                  unnest(list_distinct(toks)) AS term FROM {q}),
bm_{f} AS (SELECT p.lang, qt.item_id, p.doc_id,
                  sum(ln(1 + (fs.n_docs - d.df + 0.5) / (d.df + 0.5)) * p.tf * (1.2 + 1)
                      / (p.tf + 1.2 * (1 - 0.75 + 0.75 * p.dl / fs.avg_dl))) AS score,
                  count(*) AS matched_terms, max(qt.n_terms) AS n_terms
           FROM qt_{f} qt JOIN post_{f} p ON qt.term = p.term
           JOIN df_{f} d ON d.lang = p.lang AND d.term = p.term
           JOIN fs_{f} fs ON fs.lang = p.lang
           GROUP BY p.lang, qt.item_id, p.doc_id)"""


INDEX_SQL = BASE_SQL + "," + _field_sql("text", "dstem", "qstem") + "," + _field_sql("text_plain", "dplain", "qplain")

DISMAX_SQL = """
dm AS (SELECT coalesce(a.lang, b.lang) AS lang, coalesce(a.item_id, b.item_id) AS item_id,
              coalesce(a.doc_id, b.doc_id) AS doc_id,
              coalesce(a.score, 0.0) AS text_match, coalesce(b.score, 0.0) AS text_plain_match
       FROM bm_text a FULL OUTER JOIN bm_text_plain b
         ON a.lang = b.lang AND a.item_id = b.item_id AND a.doc_id = b.doc_id),
dmx AS (SELECT *, greatest(3.0 * text_match, text_plain_match) AS text_dismax_plain FROM dm)"""

SEARCH_SQL = f"""
sc AS (SELECT lang, item_id, doc_id, sum(s) AS score FROM (
         SELECT lang, item_id, doc_id, 1.0 * score AS s, matched_terms = n_terms AS alls FROM bm_text
         UNION ALL
         SELECT lang, item_id, doc_id, 0.5 * score AS s, matched_terms = n_terms AS alls FROM bm_text_plain)
       GROUP BY lang, item_id, doc_id HAVING bool_or(alls)),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, item_id
                                       ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS rank FROM sc)
        WHERE rank <= {TOP_N})"""

PHRASE_SQL = """
rare AS (SELECT lang, item_id, arg_min(term, (df, term)) AS term FROM (
           SELECT d.lang, q.item_id, q.term, q.n_terms, d.df FROM qt_text_plain q JOIN df_text_plain d USING (term))
         GROUP BY lang, item_id HAVING count(*) = max(n_terms)),
cand AS (SELECT r.lang, r.item_id, p.doc_id FROM rare r JOIN post_text_plain p USING (lang, term)),
ph AS (SELECT item_id, ' ' || array_to_string(toks, '  ') || ' ' AS pq FROM qplain),
bd AS (SELECT doc_id, '  ' || array_to_string(toks, '  ') || '  ' AS pd FROM dplain),
phr AS (SELECT lang, item_id, doc_id,
               CAST((length(pd) - length(replace(pd, pq, ''))) / length(pq) AS BIGINT) AS phrase_freq
        FROM cand JOIN ph USING (item_id) JOIN bd USING (doc_id)
        WHERE (length(pd) - length(replace(pd, pq, ''))) > 0)"""

EXPLORE_AGGS = [("sum", "sum"), ("min", "min"), ("max", "max"), ("mean", "avg"), ("stddev", "stddev_pop")]
EXPLORE_SQL = """
pairs AS (SELECT DISTINCT lang, item_id FROM bm_text),
ex AS (SELECT pr.lang, pr.item_id,
              CAST(coalesce(d.df, 0) AS DOUBLE) AS raw_df, CAST(coalesce(d.ttf, 0) AS DOUBLE) AS raw_ttf,
              1.0 + ln((fs.n_docs + 1.0) / (coalesce(d.df, 0) + 1.0)) AS classic_idf
       FROM pairs pr JOIN (SELECT DISTINCT item_id, term FROM qt_text) q USING (item_id)
       LEFT JOIN df_text d ON d.lang = pr.lang AND d.term = q.term
       JOIN fs_text fs ON fs.lang = pr.lang)"""


def _explore_select(prefix: str = "") -> str:
    cols = []
    for st in R.STATS:
        for name, fn in EXPLORE_AGGS:
            cols.append(f"round({fn}({st}), 9) AS {prefix}{name}_{st}")
    return ", ".join(cols)


# ---------------------------------------------------------------- Spark side
def _inputs(spark, sf_dir):
    """Queries and the document index (statistics made once, reused by every
    feature of the query)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text", "n_chars")
    return table(spark, sf_dir, "benchmark", "item_id", "text"), R.build_index(docs)


@register("term_stats", f"""
WITH {INDEX_SQL}
SELECT lang, 'text' AS field, term, df, CAST(ttf AS BIGINT) AS ttf FROM df_text
UNION ALL
SELECT lang, 'text_plain' AS field, term, df, CAST(ttf AS BIGINT) AS ttf FROM df_text_plain
""")
def q_term_stats(spark, sf_dir):
    _, docs = _inputs(spark, sf_dir)
    return R.term_stats(docs)


@register("match_score", f"""
WITH {INDEX_SQL}
SELECT lang, item_id, doc_id, round(score, 9) AS score, matched_terms, n_terms FROM bm_text
""")
def q_match_score(spark, sf_dir):
    q, docs = _inputs(spark, sf_dir)
    m = R.match_score(q, docs, "text")
    return m.select("lang", "item_id", "doc_id", rnd("score").alias("score"), "matched_terms", "n_terms")


@register("phrase_match", f"WITH {INDEX_SQL},{PHRASE_SQL} SELECT * FROM phr")
def q_phrase_match(spark, sf_dir):
    q, docs = _inputs(spark, sf_dir)
    return R.phrase_match(q, docs)


@register("explore_terms", f"""
WITH {INDEX_SQL},{EXPLORE_SQL}
SELECT lang, item_id, {_explore_select()} FROM ex GROUP BY lang, item_id
""")
def q_explore_terms(spark, sf_dir):
    q, docs = _inputs(spark, sf_dir)
    pairs = R.match_score(q, docs, "text").select("lang", "item_id")
    ex = R.explore_terms(q, docs, pairs, "text")
    return ex.select("lang", "item_id", *[rnd(c).alias(c) for c in ex.columns[2:]])


@register("unique_terms", f"""
WITH {BASE_SQL}
SELECT p.item_id, CAST(len(list_distinct(s.toks)) AS INTEGER) AS unique_terms,
       CAST(len(list_distinct(p.toks)) AS INTEGER) AS unique_terms_plain,
       CAST(len(list_distinct(s.toks)) - len(list_distinct(p.toks)) AS INTEGER) AS unique_terms_diff
FROM qplain p JOIN qstem s USING (item_id)
""")
def q_unique_terms(spark, sf_dir):
    q, _ = _inputs(spark, sf_dir)
    return R.unique_terms(q)


@register("field_value", """
SELECT d.doc_id, coalesce(CAST(l.quality AS DOUBLE), 0.0) AS quality
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def q_field_value(spark, sf_dir):
    _, docs = _inputs(spark, sf_dir)
    return R.field_value(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), "quality")


@register("token_router", f"""
WITH {INDEX_SQL},{PHRASE_SQL}
SELECT b.lang, b.item_id, b.doc_id,
       CASE WHEN len(q.toks) > {ROUTER_LIMIT} THEN 0.0 WHEN len(q.toks) > 1
            THEN coalesce(CAST(phr.phrase_freq AS DOUBLE), 0.0) ELSE 0.0 END AS phrase_routed
FROM bm_text_plain b JOIN qplain q USING (item_id)
LEFT JOIN phr ON phr.lang = b.lang AND phr.item_id = b.item_id AND phr.doc_id = b.doc_id
""")
def q_token_router(spark, sf_dir):
    q, docs = _inputs(spark, sf_dir)
    rows = R.match_score(q, docs, "text_plain").select("lang", "item_id", "doc_id")
    ph = R.phrase_match(q, docs)
    n_tok = q.select("item_id", F.size(R.analyze("text", "plain")).alias("n_tokens"))
    # joined by the document alone, as the rows lie: the few phrases move, not the many rows
    of_doc = ph.groupBy("doc_id").agg(F.collect_list(F.struct("lang", "item_id", "phrase_freq")).alias("_ph"))
    own = F.filter("_ph", lambda p: (p["lang"] == F.col("lang")) & (p["item_id"] == F.col("item_id")))
    return (rows.join(F.broadcast(n_tok), "item_id").join(of_doc, "doc_id", "left")
            .select("lang", "item_id", "doc_id", "n_tokens", F.explode_outer(F.transform(own, lambda p: p["phrase_freq"])).alias("phrase_freq"))
            .select("lang", "item_id", "doc_id",
                    R.token_router("n_tokens", "phrase_freq", ROUTER_LIMIT).alias("phrase_routed")))


def _dismax_rows(q, docs):
    from ..functions.expressions import dismax
    both = (R.match_scores(q, docs, ["text", "text_plain"])
            .withColumnsRenamed({"text": "text_match", "text_plain": "text_plain_match"})
            .fillna(0.0, ["text_match", "text_plain_match"]))
    return both.withColumn("text_dismax_plain", dismax(["text_match", "text_plain_match"], weights=[3, 1]))


@register("dismax", f"""
WITH {INDEX_SQL},{DISMAX_SQL}
SELECT lang, item_id, doc_id, round(text_match, 9) AS text_match, round(text_plain_match, 9) AS text_plain_match,
       round(text_dismax_plain, 9) AS text_dismax_plain FROM dmx
""")
def q_dismax(spark, sf_dir):
    q, docs = _inputs(spark, sf_dir)
    d = _dismax_rows(q, docs)
    return d.select("lang", "item_id", "doc_id", *[rnd(c).alias(c) for c in
                                                   ("text_match", "text_plain_match", "text_dismax_plain")])


@register("search_top_n", f"""
WITH {INDEX_SQL},{SEARCH_SQL}
SELECT lang, item_id, doc_id, round(score, 9) AS score, rank FROM top
""")
def q_search_top_n(spark, sf_dir):
    q, docs = _inputs(spark, sf_dir)
    s = R.search(q, docs, TOP_N)
    return s.select("lang", "item_id", "doc_id", rnd("score").alias("score"), "rank")


@register("rescored", f"""
WITH {INDEX_SQL},{SEARCH_SQL},
tot AS (SELECT lang, sum(n_chars) AS t FROM documents GROUP BY lang),
sig AS (SELECT d.doc_id, d.n_chars / tot.t AS popularity,
               CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS links
        FROM documents d JOIN tot USING (lang)),
rs AS (SELECT top.*, top.score
              + 3.0 * pow(popularity, 0.8) / (pow(popularity, 0.8) + pow(8e-6, 0.8))
              + 10.0 * pow(links, 0.7) / (pow(links, 0.7) + pow(30.0, 0.7)) AS rescored
       FROM top JOIN sig USING (doc_id))
SELECT lang, item_id, doc_id, round(rescored, 9) AS rescored,
       CAST(row_number() OVER (PARTITION BY lang, item_id ORDER BY round(rescored, 9) DESC, doc_id) AS INTEGER)
         AS rescored_rank
FROM rs
""")
def q_rescored(spark, sf_dir):
    q, docs = _inputs(spark, sf_dir)
    top = R.search(q, docs, TOP_N).join(R.doc_signals(docs.docs).drop("lang"), "doc_id")
    r = R.rescore(top, "popularity", "links")
    return r.select("lang", "item_id", "doc_id", rnd("rescored").alias("rescored"), "rescored_rank")
