"""Registered queries over the click log derived from the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import at_least_n_distinct_over
from ..operators import clicks, ranking_metrics
from ..sources.tables import CLICK_ROWS_SQL, click_rows, raw_click_log
from .registry import joined, register, rnd

WIKIS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")
GATE_SESSIONS = 60

H = f"h AS ({CLICK_ROWS_SQL})"

# Nested log in SQL: hits/clicks as ordered page lists, q_by_ip_day per customer-day.
RAW_LOG_SQL = f"""
{H},
ip AS (SELECT CAST(o_orderkey AS VARCHAR) AS session_id,
              CAST(count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS INTEGER) AS q_by_ip_day
       FROM orders),
s AS (SELECT wikiid, query, session_id,
             list(hit_page_id ORDER BY hit_position) AS hit_page_ids,
             coalesce(list(hit_page_id ORDER BY hit_position) FILTER (WHERE clicked), []) AS click_page_ids
      FROM h GROUP BY wikiid, query, session_id)
"""


@register("click_log", f"""
WITH {RAW_LOG_SQL.strip()}
SELECT s.wikiid, s.query, s.session_id,
       array_to_string(hit_page_ids, ',') AS hit_page_ids,
       array_to_string(click_page_ids, ',') AS click_page_ids
FROM s JOIN ip USING (session_id)
WHERE s.wikiid IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') AND q_by_ip_day < 50
""")
def q_click_log(spark, sf_dir):
    log = clicks.clean_click_log(raw_click_log(spark, sf_dir), WIKIS, 50)
    return log.select("wikiid", "query", "session_id",
                      joined("hit_page_ids").alias("hit_page_ids"),
                      joined("click_page_ids").alias("click_page_ids"))


@register("exploded_hits", f"""
WITH {RAW_LOG_SQL.strip()},
e AS (SELECT s.wikiid, s.query, s.session_id, s.hit_page_ids, s.click_page_ids,
             CAST(unnest(range(len(s.hit_page_ids))) AS INTEGER) AS hit_position,
             unnest(s.hit_page_ids) AS hit_page_id
      FROM s JOIN ip USING (session_id) WHERE q_by_ip_day < 50)
SELECT wikiid, query, session_id, hit_position, hit_page_id,
       list_contains(click_page_ids, hit_page_id) AS clicked
FROM e
""")
def q_exploded_hits(spark, sf_dir):
    log = clicks.clean_click_log(raw_click_log(spark, sf_dir), None, 50)
    return clicks.explode_hits(log).select("wikiid", "query", "session_id", "hit_position",
                                           "hit_page_id", "clicked")


@register("session_gate", f"""
WITH {H},
d AS (SELECT DISTINCT wikiid, query, session_id FROM h),
g AS (SELECT wikiid, query, count(DISTINCT session_id) >= {GATE_SESSIONS} AS has_min_sessions
      FROM d GROUP BY wikiid, query)
SELECT DISTINCT h.wikiid, h.query, h.norm_query, g.has_min_sessions
FROM h JOIN g USING (wikiid, query)
""")
def q_session_gate(spark, sf_dir):
    h = click_rows(spark, sf_dir).select("wikiid", "query", "norm_query", "session_id")
    gate = at_least_n_distinct_over("session_id", GATE_SESSIONS, ["wikiid", "query"])
    return (h.withColumn("has_min_sessions", gate)
            .select("wikiid", "query", "norm_query", "has_min_sessions").dropDuplicates())


@register("session_gate_grouped", f"""
WITH {H}
SELECT h.wikiid, h.query, count(*) AS n_rows
FROM h JOIN (SELECT wikiid, query FROM h GROUP BY wikiid, query
             HAVING count(DISTINCT session_id) >= {GATE_SESSIONS}) g USING (wikiid, query)
GROUP BY h.wikiid, h.query
""")
def q_session_gate_grouped(spark, sf_dir):
    h = click_rows(spark, sf_dir)
    return (clicks.session_gate(h, ["wikiid", "query"], GATE_SESSIONS)
            .groupBy("wikiid", "query").agg(F.count(F.lit(1)).alias("n_rows")))


def _ndcg_sql(source: str, qcols: str, pos: str, k: int = 10) -> str:
    return f"""
r AS (SELECT {qcols}, label,
             row_number() OVER (PARTITION BY {qcols} ORDER BY {pos}, hit_page_id) AS rp,
             row_number() OVER (PARTITION BY {qcols} ORDER BY label DESC) AS rl
      FROM {source}),
q AS (SELECT {qcols},
             sum(CASE WHEN rp <= {k} THEN (pow(2, label) - 1) / log2(rp + 1) ELSE 0 END) AS dcg,
             sum(CASE WHEN rl <= {k} THEN (pow(2, label) - 1) / log2(rl + 1) ELSE 0 END) AS idcg
      FROM r GROUP BY {qcols})
SELECT wikiid, round(avg(CASE WHEN idcg = 0 THEN 0.0 ELSE dcg / idcg END), 9) AS ndcg
FROM q GROUP BY wikiid
"""


def ndcg_weighted(spark, sf_dir):
    h = click_rows(spark, sf_dir)
    out = ranking_metrics.ndcg(h, 10, query_cols=("wikiid", "query", "session_id"))
    return out.select("wikiid", rnd("ndcg").alias("ndcg"))


register("ndcg_weighted", f"WITH {H},{_ndcg_sql('h', 'wikiid, query, session_id', 'hit_position')}")(ndcg_weighted)

PAGES_SQL = """
p AS (SELECT wikiid, query, hit_page_id, count(*) AS weight, avg(hit_position) AS hit_position,
             max(label) AS label
      FROM h GROUP BY wikiid, query, hit_page_id)"""


@register("ndcg_unweighted", f"WITH {H},{PAGES_SQL},{_ndcg_sql('p', 'wikiid, query', 'hit_position')}")
def q_ndcg_unweighted(spark, sf_dir):
    h = click_rows(spark, sf_dir)
    pages = (h.groupBy("wikiid", "query", "hit_page_id")
             .agg(F.avg("hit_position").alias("hit_position"), F.max("label").alias("label")))
    out = ranking_metrics.ndcg(pages, 10, query_cols=("wikiid", "query"))
    return out.select("wikiid", rnd("ndcg").alias("ndcg"))


SESSION_HITS_SQL = f"""
{H},
pp AS (SELECT wikiid, norm_query_id, session_id, hit_page_id,
              avg(hit_position) AS mean_position, bool_or(clicked) AS clicked
       FROM h GROUP BY wikiid, norm_query_id, session_id, hit_page_id),
sh AS (SELECT wikiid, norm_query_id, session_id, hit_page_id, clicked,
              CAST(row_number() OVER (PARTITION BY wikiid, norm_query_id, session_id
                                      ORDER BY mean_position, hit_page_id) - 1 AS INTEGER) AS hit_position
       FROM pp)"""


@register("session_hits", f"WITH {SESSION_HITS_SQL} SELECT * FROM sh")
def q_session_hits(spark, sf_dir):
    s = clicks.session_hits(click_rows(spark, sf_dir))
    return clicks.session_hits_long(s)


MIN_DOCS, MAX_DOCS = 2, 10


@register("eligible_sessions", f"""
WITH {SESSION_HITS_SQL},
ok AS (SELECT wikiid, norm_query_id, session_id FROM sh
       GROUP BY wikiid, norm_query_id, session_id
       HAVING count(*) >= {MIN_DOCS} AND bool_or(clicked AND hit_position < {MAX_DOCS}))
SELECT sh.* FROM sh JOIN ok USING (wikiid, norm_query_id, session_id)
WHERE hit_position < {MAX_DOCS}
""")
def q_eligible_sessions(spark, sf_dir):
    s = clicks.session_hits(click_rows(spark, sf_dir))
    return clicks.session_hits_long(clicks.eligible_sessions(s, MIN_DOCS, MAX_DOCS))


def entry_query(spark, sf_dir):
    """Flagship: click log → session-weighted NDCG@10 per wiki."""
    return ndcg_weighted(spark, sf_dir)
