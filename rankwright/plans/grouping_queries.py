"""Registered queries: top hits, query similarity, query groups, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grouping, sampling
from ..functions.columns import normalise_query
from ..session import cut_lineage
from ..sources.tables import click_rows, table
from .click_queries import H
from .registry import register, rnd

TOP_N = 5
THRESHOLD = 0.5
MIN_SESSIONS = 10
SAMPLES_PER_WIKI, SEED, BUCKETS = 500, 54321, 10

TOP_SQL = f"""
{H},
c AS (SELECT wikiid, norm_query, query, hit_page_id, count(*) AS n_shown FROM h
      GROUP BY wikiid, norm_query, query, hit_page_id),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY wikiid, norm_query, query
                                                  ORDER BY n_shown DESC, hit_page_id) AS rk FROM c)
      WHERE rk <= {TOP_N}),
s AS (SELECT wikiid, norm_query, query, list_sort(list(hit_page_id)) AS st FROM t
      GROUP BY wikiid, norm_query, query),
p AS (SELECT a.wikiid, a.norm_query, a.query AS query_a, b.query AS query_b,
             len(list_intersect(a.st, b.st)) AS inter,
             len(a.st) + len(b.st) - len(list_intersect(a.st, b.st)) AS uni
      FROM s a JOIN s b ON a.wikiid = b.wikiid AND a.norm_query = b.norm_query AND a.query < b.query
      WHERE len(a.st) > 0 AND len(b.st) > 0)"""


@register("query_top_hits", f"""
WITH {H},
c AS (SELECT wikiid, query, hit_page_id, count(*) AS n_shown FROM h GROUP BY wikiid, query, hit_page_id)
SELECT wikiid, query, hit_page_id, n_shown, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY wikiid, query ORDER BY n_shown DESC, hit_page_id) AS rk FROM c)
WHERE rk <= {TOP_N}
""")
def q_query_top_hits(spark, sf_dir):
    return grouping.top_hits(click_rows(spark, sf_dir), TOP_N, ("wikiid", "query"))


def _sets(spark, sf_dir):
    h = click_rows(spark, sf_dir)
    keys = ("wikiid", "norm_query", "query")
    return grouping.hit_sets(grouping.top_hits(h, TOP_N, keys), keys)


@register("query_jaccard", f"""
WITH {TOP_SQL}
SELECT wikiid, norm_query, query_a, query_b, CAST(inter AS INTEGER) AS intersection_size,
       CAST(uni AS INTEGER) AS union_size, round(inter / uni, 9) AS jaccard
FROM p WHERE inter / uni > {THRESHOLD}
""")
def q_query_jaccard(spark, sf_dir):
    pairs = grouping.query_similarity(_sets(spark, sf_dir), THRESHOLD, ("wikiid", "norm_query"), "query")
    return pairs.select("wikiid", "norm_query", "query_a", "query_b",
                        F.col("intersection").alias("intersection_size"),
                        F.col("union").alias("union_size"), rnd("jaccard").alias("jaccard"))


@register("query_groups", f"""
WITH RECURSIVE {TOP_SQL.strip()},
g1 AS (SELECT wikiid, norm_query FROM h GROUP BY wikiid, norm_query
       HAVING count(DISTINCT session_id) >= {MIN_SESSIONS}),
qs AS (SELECT DISTINCT wikiid, norm_query, query FROM h JOIN g1 USING (wikiid, norm_query)),
e AS (SELECT wikiid, norm_query, query_a AS a, query_b AS b FROM p WHERE inter / uni > {THRESHOLD}
      UNION ALL
      SELECT wikiid, norm_query, query_b AS a, query_a AS b FROM p WHERE inter / uni > {THRESHOLD}),
reach(wikiid, norm_query, q, r) AS (
      SELECT wikiid, norm_query, query, query FROM qs
      UNION
      SELECT reach.wikiid, reach.norm_query, reach.q, e.b
      FROM reach JOIN e ON reach.wikiid = e.wikiid AND reach.norm_query = e.norm_query AND reach.r = e.a),
comp AS (SELECT wikiid, norm_query, q AS query, min(r) AS group_query FROM reach
         GROUP BY wikiid, norm_query, q),
g2 AS (SELECT wikiid, norm_query, group_query FROM h JOIN comp USING (wikiid, norm_query, query)
       GROUP BY wikiid, norm_query, group_query HAVING count(DISTINCT session_id) >= {MIN_SESSIONS})
SELECT wikiid, norm_query, query, group_query FROM comp JOIN g2 USING (wikiid, norm_query, group_query)
""")
def q_query_groups(spark, sf_dir):
    h = click_rows(spark, sf_dir).drop("norm_query_id")
    grouped = grouping.group_queries(h, THRESHOLD, MIN_SESSIONS, TOP_N, "norm_query")
    return grouped.select("wikiid", "norm_query", "query", "group_query").distinct()


@register("distinct_pages_per_wiki", f"""
WITH {H},
q AS (SELECT wikiid, query, count(DISTINCT hit_page_id) AS n FROM h GROUP BY wikiid, query)
SELECT wikiid, CAST(sum(n) AS BIGINT) AS num_hit_page_ids FROM q GROUP BY wikiid
""")
def q_distinct_pages(spark, sf_dir):
    return sampling.page_counts(click_rows(spark, sf_dir))


@register("sessions_per_query", f"""
WITH {H}
SELECT wikiid, norm_query_id, count(DISTINCT session_id) AS num_sessions FROM h
GROUP BY wikiid, norm_query_id
""")
def q_sessions_per_query(spark, sf_dir):
    return sampling.session_counts(click_rows(spark, sf_dir), ("wikiid", "norm_query_id"))


@register("session_quantiles", f"""
WITH {H},
k AS (SELECT wikiid, query, count(DISTINCT session_id) AS n FROM h GROUP BY wikiid, query),
r AS (SELECT wikiid, n, row_number() OVER (PARTITION BY wikiid ORDER BY n) AS i, count(*) OVER (PARTITION BY wikiid) AS c FROM k)
SELECT DISTINCT wikiid, CAST(n AS DOUBLE) AS edge FROM r JOIN range(1, {BUCKETS}) q(j) ON i = ceil(j * c / {BUCKETS})
""")
def q_session_quantiles(spark, sf_dir):
    keys = sampling.session_counts(click_rows(spark, sf_dir), ("wikiid", "query"))
    edges = sampling.exact_quantile_edges(keys, "wikiid", "num_sessions", BUCKETS)
    return edges.select("wikiid", F.explode("edges").alias("edge")).where(F.col("edge") < float("inf"))


@register("norm_query", f"""
WITH {H},
q AS (SELECT DISTINCT query, substr(lower(wikiid), 1, 2) AS lang FROM h
      UNION SELECT DISTINCT text, lang FROM documents),
t AS (SELECT query, lang, lower(unnest(regexp_extract_all(query, '[\\p{{L}}\\p{{N}}]+'))) AS w FROM q),
s AS (SELECT query, lang, CASE WHEN length(w) <= 4 THEN w
        WHEN lang = 'en' THEN regexp_replace(w, '(ing|es|s)$', '') WHEN lang = 'de' THEN regexp_replace(w, '(en|er|e)$', '')
        WHEN lang = 'fr' THEN regexp_replace(w, '(es|s|e)$', '') WHEN lang = 'es' THEN regexp_replace(w, '(es|s)$', '')
        ELSE w END AS w FROM t)
SELECT q.query, q.lang, coalesce(string_agg(DISTINCT w, ' ' ORDER BY w), '') AS norm FROM q LEFT JOIN s USING (query, lang)
GROUP BY q.query, q.lang
""")
def q_norm_query(spark, sf_dir):
    """Normal form of the log's queries and of all document texts in their language."""
    log = click_rows(spark, sf_dir).select("query", F.substring(F.lower("wikiid"), 1, 2).alias("lang"))
    texts = table(spark, sf_dir, "documents", "text", "lang").select(F.col("text").alias("query"), "lang")
    return log.unionByName(texts).distinct().select("query", "lang", normalise_query("query", "lang").alias("norm"))


@register("sampled_log", f"""
WITH {H},
cnt AS (SELECT wikiid, sum(n) AS num_hit_page_ids FROM
          (SELECT wikiid, query, count(DISTINCT hit_page_id) AS n FROM h GROUP BY wikiid, query)
        GROUP BY wikiid),
fr AS (SELECT wikiid, least(1.0, CAST({SAMPLES_PER_WIKI} AS DOUBLE) / num_hit_page_ids) AS fraction FROM cnt),
k AS (SELECT wikiid, query, count(DISTINCT session_id) AS num_sessions FROM h GROUP BY wikiid, query),
hist AS (SELECT wikiid, num_sessions, count(*) AS c FROM k GROUP BY wikiid, num_sessions),
cum AS (SELECT *, sum(c) OVER (PARTITION BY wikiid ORDER BY num_sessions
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cu,
               sum(c) OVER (PARTITION BY wikiid) AS tot FROM hist),
ed AS (SELECT DISTINCT wikiid, num_sessions AS edge FROM cum JOIN range(1, {BUCKETS}) r(kk)
       ON cu * {BUCKETS} >= kk * tot AND (cu - c) * {BUCKETS} < kk * tot),
st AS (SELECT k.wikiid, k.query, k.num_sessions,
              (SELECT count(*) FROM ed WHERE ed.wikiid = k.wikiid AND ed.edge < k.num_sessions) AS stratum
       FROM k),
rk AS (SELECT st.wikiid, st.query, fr.fraction,
              count(*) OVER (PARTITION BY st.wikiid, stratum) AS n,
              row_number() OVER (PARTITION BY st.wikiid, stratum
                                 ORDER BY md5(concat_ws('/', '{SEED}', st.wikiid, st.query)), st.query) AS rn
       FROM st JOIN fr USING (wikiid)),
chosen AS (SELECT wikiid, query FROM rk WHERE rn <= floor(fraction * n + 0.5))
SELECT wikiid, query, session_id, hit_position, hit_page_id FROM h JOIN chosen USING (wikiid, query)
""")
def q_sampled_log(spark, sf_dir):
    # the log's key columns are read by the counts, the sessions and the sample: made once
    h = cut_lineage(click_rows(spark, sf_dir).select("wikiid", "query", "session_id", "hit_position", "hit_page_id"))
    _, sample = sampling.sample_queries(h, SAMPLES_PER_WIKI, SEED, key_col="query", num_buckets=BUCKETS)
    return sample.select("wikiid", "query", "session_id", "hit_position", "hit_page_id")
