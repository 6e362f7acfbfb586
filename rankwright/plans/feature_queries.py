"""Registered queries: feature rows, completeness, vector ops, timestamp and token counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import parse_compact_ts
from ..functions.expressions import Feature, default_features, dismax_expression
from ..operators import features as FT
from ..operators import retrieval as R
from ..sources.tables import table
from .registry import register, rnd
from .retrieval_queries import INDEX_SQL, PHRASE_SQL, ROUTER_LIMIT, SEARCH_SQL, TOP_N

# The feature set collected for the search candidates.
FEATURES = [
    Feature("text_match", "match", "text"),
    Feature("text_plain_match", "match", "text_plain"),
    Feature("text_dismax_plain", "derived", None,
            {"expression": dismax_expression(["text_match", "text_plain_match"], weights=[3, 1])}),
    Feature("text_sum_classic_idf", "explorer", "text", {"agg": "sum", "stat": "classic_idf"}),
    Feature("text_phrase_routed", "token_router", "text_plain", {"limit": ROUTER_LIMIT}),
    Feature("unique_terms", "terms_count", "text"),
    Feature("quality", "field_value", "quality"),
]
NAMES = [f.name for f in FEATURES]

FEATURE_ROWS_SQL = f"""
{INDEX_SQL},{SEARCH_SQL},{PHRASE_SQL},
cpairs AS (SELECT DISTINCT lang, item_id FROM top),
idf AS (SELECT pr.lang, pr.item_id,
               sum(1.0 + ln((fs.n_docs + 1.0) / (coalesce(d.df, 0) + 1.0))) AS text_sum_classic_idf
        FROM cpairs pr JOIN (SELECT DISTINCT item_id, term FROM qt_text) q USING (item_id)
        LEFT JOIN df_text d ON d.lang = pr.lang AND d.term = q.term
        JOIN fs_text fs ON fs.lang = pr.lang
        GROUP BY pr.lang, pr.item_id),
fr AS (SELECT t.lang, t.item_id, t.doc_id,
              coalesce(a.score, 0.0) AS text_match,
              coalesce(b.score, 0.0) AS text_plain_match,
              coalesce(i.text_sum_classic_idf, 0.0) AS text_sum_classic_idf,
              CASE WHEN len(qp.toks) > {ROUTER_LIMIT} THEN 0.0 WHEN len(qp.toks) > 1
                   THEN coalesce(CAST(phr.phrase_freq AS DOUBLE), 0.0) ELSE 0.0 END AS text_phrase_routed,
              CAST(len(list_distinct(qs.toks)) AS DOUBLE) AS unique_terms,
              coalesce(CAST(l.quality AS DOUBLE), 0.0) AS quality
       FROM top t
       LEFT JOIN bm_text a ON a.lang = t.lang AND a.item_id = t.item_id AND a.doc_id = t.doc_id
       LEFT JOIN bm_text_plain b ON b.lang = t.lang AND b.item_id = t.item_id AND b.doc_id = t.doc_id
       LEFT JOIN idf i ON i.lang = t.lang AND i.item_id = t.item_id
       LEFT JOIN phr ON phr.lang = t.lang AND phr.item_id = t.item_id AND phr.doc_id = t.doc_id
       JOIN qplain qp ON qp.item_id = t.item_id
       JOIN qstem qs ON qs.item_id = t.item_id
       LEFT JOIN labels l ON l.doc_id = t.doc_id),
frx AS (SELECT *, greatest(3.0 * text_match, text_plain_match) AS text_dismax_plain FROM fr)"""


def feature_rows(spark, sf_dir):
    q = table(spark, sf_dir, "benchmark", "item_id", "text")
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    index = R.build_index(docs)
    cand = R.search(q, index, TOP_N)
    return FT.collect_features(cand, q, index, FEATURES, values=labels)


@register("feature_rows", f"""
WITH {FEATURE_ROWS_SQL}
SELECT lang, item_id, doc_id, {", ".join(f"round({n}, 9) AS {n}" for n in NAMES)} FROM frx
""")
def q_feature_rows(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    return rows.select("lang", "item_id", "doc_id", *[rnd(n).alias(n) for n in NAMES])


@register("feature_completeness", f"""
WITH {FEATURE_ROWS_SQL}
{" UNION ALL ".join(f"SELECT '{n}' AS feature, count({n}) AS n_values FROM frx" for n in NAMES)}
""")
def q_feature_completeness(spark, sf_dir):
    return FT.feature_completeness(feature_rows(spark, sf_dir), NAMES)


def _rounded_vectors(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    rounded = rows.select("lang", "item_id", "doc_id", *[rnd(n).alias(n) for n in NAMES])
    return FT.assemble(rounded, NAMES)


@register("feature_append", f"""
WITH {FEATURE_ROWS_SQL}
SELECT frx.lang, item_id, doc_id, {", ".join(f"CAST(round({n}, 9) AS FLOAT) AS {n}" for n in NAMES)},
       CAST(d.n_chars AS FLOAT) AS n_chars
FROM frx JOIN documents d USING (doc_id)
""")
def q_feature_append(spark, sf_dir):
    vec = _rounded_vectors(spark, sf_dir)
    docs = table(spark, sf_dir, "documents", "doc_id", "n_chars")
    appended = FT.append_features(vec.join(docs, "doc_id"), "n_chars").drop("n_chars")
    return FT.explode_features(appended)


ZEROED = ("text_match", "quality")


@register("feature_zero", f"""
WITH {FEATURE_ROWS_SQL}
SELECT lang, item_id, doc_id,
       {", ".join(("CAST(0.0 AS FLOAT)" if n in ZEROED else f"CAST(round({n}, 9) AS FLOAT)") + f" AS {n}"
                  for n in NAMES)}
FROM frx
""")
def q_feature_zero(spark, sf_dir):
    return FT.explode_features(FT.zero_features(_rounded_vectors(spark, sf_dir), *ZEROED))


@register("feature_explode", f"""
WITH {FEATURE_ROWS_SQL}
SELECT lang, item_id, doc_id, CAST(round(text_match, 9) AS FLOAT) AS text_match,
       CAST(round(quality, 9) AS FLOAT) AS quality
FROM frx
""")
def q_feature_explode(spark, sf_dir):
    return FT.explode_features(_rounded_vectors(spark, sf_dir), ["text_match", "quality"])


@register("page_age", """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS ts_compact,
       CAST(epoch(strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S')) AS BIGINT) AS unix_seconds
FROM events
""")
def q_page_age(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "ts")
    compact = ev.select("event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("ts_compact"))
    return compact.withColumn("unix_seconds", parse_compact_ts("ts_compact"))


@register("query_token_counts", r"""
WITH qs AS (SELECT text AS query FROM benchmark UNION SELECT text AS query FROM conversations WHERE role = 'user'),
tc AS (SELECT query,
              CAST(len(list_filter(regexp_split_to_array(lower(query), '[^\p{L}\p{N}]+'),
                                   lambda x: length(x) > 0)) AS INTEGER) AS tokens_plain,
              CAST(len(list_filter(regexp_split_to_array(query, '\s+'), lambda x: length(x) > 0)) AS INTEGER)
                AS tokens_whitespace
       FROM qs)
SELECT c.conv_id, c.turn, tc.tokens_plain, tc.tokens_whitespace
FROM conversations c JOIN tc ON tc.query = c.text WHERE c.role = 'user'
""")
def q_query_token_counts(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark", "text").withColumnRenamed("text", "query")
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    user = conv.where(F.col("role") == "user")
    queries = FT.union_distinct_queries(bench, user.select(F.col("text").alias("query")))
    counts = FT.token_counts(queries)
    return (user.join(counts, user.text == counts.query)
            .select("conv_id", "turn", "tokens_plain", "tokens_whitespace"))


# Statistics of the text field and its analyzers over the search candidates; all fields: field_queries.
DEFAULT = default_features()
DEFAULT_NAMES = [f.name for f in DEFAULT]


def _explore_field_sql(fld: str, prefix: str) -> str:
    aggs = [("sum", "sum"), ("min", "min"), ("max", "max"), ("mean", "avg"), ("stddev", "stddev_pop")]
    sel = ", ".join(f"{fn}({st}) AS {prefix}_{name}_{st}" for st in ("raw_df", "classic_idf", "raw_ttf")
                    for name, fn in aggs)
    return f"""
ex_{fld} AS (SELECT lang, item_id, {sel} FROM (
    SELECT pr.lang, pr.item_id,
           CAST(coalesce(d.df, 0) AS DOUBLE) AS raw_df, CAST(coalesce(d.ttf, 0) AS DOUBLE) AS raw_ttf,
           1.0 + ln((fs.n_docs + 1.0) / (coalesce(d.df, 0) + 1.0)) AS classic_idf
    FROM cpairs pr JOIN (SELECT DISTINCT item_id, term FROM qt_{fld}) q USING (item_id)
    LEFT JOIN df_{fld} d ON d.lang = pr.lang AND d.term = q.term
    JOIN fs_{fld} fs ON fs.lang = pr.lang) GROUP BY lang, item_id)"""


DEFAULT_ROWS_SQL = f"""
{INDEX_SQL},{SEARCH_SQL},{PHRASE_SQL},
cpairs AS (SELECT DISTINCT lang, item_id FROM top),{_explore_field_sql("text", "text")},
{_explore_field_sql("text_plain", "text_plain")},
dr AS (SELECT t.lang, t.item_id, t.doc_id, ext.* EXCLUDE (lang, item_id), exp.* EXCLUDE (lang, item_id),
              coalesce(a.score, 0.0) AS text_match, coalesce(b.score, 0.0) AS text_plain_match,
              CASE WHEN len(qp.toks) > 10 THEN 0.0 WHEN len(qp.toks) > 1
                   THEN coalesce(CAST(phr.phrase_freq AS DOUBLE), 0.0) ELSE 0.0 END AS text_phrase_routed,
              CAST(len(list_distinct(qs.toks)) AS DOUBLE) AS unique_terms,
              CAST(len(list_distinct(qp.toks)) AS DOUBLE) AS unique_terms_plain,
              coalesce(CAST(l.quality AS DOUBLE), 0.0) AS quality
       FROM top t
       LEFT JOIN bm_text a ON a.lang = t.lang AND a.item_id = t.item_id AND a.doc_id = t.doc_id
       LEFT JOIN bm_text_plain b ON b.lang = t.lang AND b.item_id = t.item_id AND b.doc_id = t.doc_id
       LEFT JOIN ex_text ext ON ext.lang = t.lang AND ext.item_id = t.item_id
       LEFT JOIN ex_text_plain exp ON exp.lang = t.lang AND exp.item_id = t.item_id
       LEFT JOIN phr ON phr.lang = t.lang AND phr.item_id = t.item_id AND phr.doc_id = t.doc_id
       JOIN qplain qp ON qp.item_id = t.item_id
       JOIN qstem qs ON qs.item_id = t.item_id
       LEFT JOIN labels l ON l.doc_id = t.doc_id),
drx AS (SELECT *, greatest(3.0 * text_match, text_plain_match) AS text_dismax_plain,
               unique_terms - unique_terms_plain AS unique_terms_diff FROM dr)"""


@register("text_feature_rows", f"""
WITH {DEFAULT_ROWS_SQL}
SELECT lang, item_id, doc_id, {", ".join(f"round(coalesce({n}, 0.0), 9) AS {n}" for n in DEFAULT_NAMES)} FROM drx
""")
def q_text_feature_rows(spark, sf_dir):
    q = table(spark, sf_dir, "benchmark", "item_id", "text")
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    index = R.build_index(docs)
    rows = FT.collect_features(R.search(q, index, TOP_N), q, index, DEFAULT, values=labels)
    return rows.select("lang", "item_id", "doc_id", *[rnd(n).alias(n) for n in DEFAULT_NAMES])
