"""Registered queries: click-model relevance, labels, sample gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import click_model, clicks, sampling
from ..operators import features as FT
from ..sources.tables import TRAIN_FEATURES, TRAINING_ROWS_SQL, click_rows, training_rows
from .click_queries import H, MAX_DOCS, MIN_DOCS
from .registry import register, rnd

SAMPLES_PER_WIKI, TOLERANCE = 1000, 0.5


@register("click_relevance")
def q_click_relevance(spark, sf_dir):
    """M3 on the whole click log: sessions → eligible (min 2, max 10 docs) → EM."""
    h = click_rows(spark, sf_dir)
    sessions = clicks.eligible_sessions(clicks.session_hits(h), MIN_DOCS, MAX_DOCS)
    rel = click_model.click_model(sessions, iterations=40, default_rel=0.5, gamma=0.9)
    return rel.select("wikiid", "norm_query_id", "hit_page_id", rnd("relevance").alias("relevance"))


def _ctr(h):
    """A SQL-computable relevance: click-through rate per (wiki, norm query, page)."""
    return (h.groupBy("wikiid", "norm_query_id", "hit_page_id")
            .agg(F.avg(F.col("clicked").cast("double")).alias("relevance")))


CTR_SQL = f"""
{H},
rel AS (SELECT wikiid, norm_query_id, hit_page_id, avg(CAST(clicked AS DOUBLE)) AS relevance
        FROM h GROUP BY wikiid, norm_query_id, hit_page_id),
ah AS (SELECT h.wikiid, h.query, h.norm_query_id, h.hit_page_id, h.session_id, h.hit_position,
              rel.relevance, CAST(trunc(rel.relevance * 10) AS INTEGER) AS label
       FROM h JOIN rel USING (wikiid, norm_query_id, hit_page_id)),
lab AS (SELECT wikiid, query, norm_query_id, hit_page_id, count(*) AS weight,
               avg(hit_position) AS hit_position, max(label) AS label, max(relevance) AS relevance
        FROM ah GROUP BY wikiid, query, norm_query_id, hit_page_id)"""


@register("labeled_hits", f"""
WITH {CTR_SQL}
SELECT wikiid, query, norm_query_id, hit_page_id, weight, round(hit_position, 9) AS hit_position,
       label, round(relevance, 9) AS relevance FROM lab
""")
def q_labeled_hits(spark, sf_dir):
    h = click_rows(spark, sf_dir)
    _, labeled = clicks.label_hits(h, _ctr(h))
    return labeled.select("wikiid", "query", "norm_query_id", "hit_page_id", "weight",
                          rnd("hit_position").alias("hit_position"), "label",
                          rnd("relevance").alias("relevance"))


@register("sample_gate", f"""
WITH {CTR_SQL},
cnt AS (SELECT wikiid, CAST(sum(n) AS BIGINT) AS num_hit_page_ids FROM
          (SELECT wikiid, query, count(DISTINCT hit_page_id) AS n FROM h GROUP BY wikiid, query)
        GROUP BY wikiid),
act AS (SELECT wikiid, count(*) AS n_obs FROM lab GROUP BY wikiid)
SELECT cnt.wikiid, CAST(coalesce(n_obs, 0) AS BIGINT) AS n_obs,
       CAST(least({SAMPLES_PER_WIKI}, num_hit_page_ids) AS BIGINT) AS expected,
       coalesce(n_obs, 0) > 0 AND coalesce(n_obs, 0) / least({SAMPLES_PER_WIKI}, num_hit_page_ids) >= {TOLERANCE}
         AS ok
FROM cnt LEFT JOIN act USING (wikiid)
""")
def q_sample_gate(spark, sf_dir):
    h = click_rows(spark, sf_dir)
    counts = sampling.page_counts(h)
    _, labeled = clicks.label_hits(h, _ctr(h))
    return clicks.sample_gate(labeled, counts, SAMPLES_PER_WIKI, TOLERANCE)


@register("labeled_features", f"""
WITH {CTR_SQL},{TRAINING_ROWS_SQL.replace("h AS (", "h2 AS (", 1).replace("FROM h GROUP BY", "FROM h2 GROUP BY")}
SELECT lab.wikiid, lab.query, lab.hit_page_id, lab.label, lab.weight,
       {", ".join(f"round(tr.{f}, 9) AS {f}" for f in TRAIN_FEATURES)}
FROM lab JOIN tr ON lab.wikiid = tr.wikiid AND lab.query = tr.query AND lab.hit_page_id = tr.hit_page_id
""")
def q_labeled_features(spark, sf_dir):
    """Click-model-style labels (CTR relevance) joined to the feature rows."""
    h = click_rows(spark, sf_dir)
    _, labeled = clicks.label_hits(h, _ctr(h))
    feats = training_rows(spark, sf_dir).drop("label")
    joined = FT.join_features(labeled.select("wikiid", "query", "hit_page_id", "label", "weight"), feats)
    return joined.select("wikiid", "query", "hit_page_id", "label", "weight",
                         *[rnd(f).alias(f) for f in TRAIN_FEATURES])
