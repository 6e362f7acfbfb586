"""Registered queries: responses, run completion, update validation / routing /
results, counter EMA and load gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import click_rows, table
from ..streaming import counters, responses, updates
from .click_queries import H
from .registry import register, rnd

RUN_ID = "r1"
CLUSTERS = [("north", ["en", "de"]), ("south", ["en", "fr"])]
ALPHA, MAX_VALID, THRESHOLD = 0.1, 660.0, 0.004


def _envelopes(spark, sf_dir):
    """One response envelope per search session, status from the order status
    (F → 200, O → 503, P → 500); every envelope is delivered twice (replay)."""
    h = click_rows(spark, sf_dir)
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    sess = (h.groupBy("wikiid", "query", "session_id")
            .agg(F.sort_array(F.collect_list(F.struct("hit_position", "hit_page_id"))).alias("h")))
    status = (F.when(F.col("o_orderstatus") == "F", 200)
              .when(F.col("o_orderstatus") == "O", 503).otherwise(500))
    env = (sess.join(orders, sess.session_id == orders.o_orderkey.cast("string"))
           .select(F.to_json(F.struct(
               F.lit(RUN_ID).alias("run_id"),
               F.struct("wikiid", "query").alias("meta"),
               status.alias("status_code"),
               F.to_json(F.struct(F.transform("h", lambda x: F.struct(x["hit_page_id"].alias("pageid")))
                                  .alias("hits"))).alias("text"))).alias("value")))
    return env.unionAll(env)


@register("response_hits", f"""
WITH {H}
SELECT DISTINCT h.wikiid, h.query, h.hit_page_id
FROM h JOIN orders o ON h.session_id = CAST(o.o_orderkey AS VARCHAR)
WHERE o.o_orderstatus = 'F'
""")
def q_response_hits(spark, sf_dir):
    return responses.collect_responses(responses.parse_envelopes(_envelopes(spark, sf_dir)), RUN_ID)


@register("run_complete", """
WITH e AS (SELECT count(DISTINCT user_id) AS n FROM events)
SELECT event_type AS run_id, count(DISTINCT user_id) AS n_partitions,
       count(DISTINCT user_id) >= (SELECT n FROM e) AS complete
FROM events GROUP BY event_type
""")
def q_run_complete(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_type", "user_id")
    markers = ev.select(F.col("event_type").alias("run_id"), F.col("user_id").cast("int").alias("partition"),
                        F.lit(True).alias("complete"))
    expected = ev.agg(F.count_distinct("user_id")).first()[0]  # one number
    return responses.run_complete(markers, expected)


def _update_messages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    conv = table(spark, sf_dir, "conversations", "role", "text")
    good = docs.select(F.to_json(F.struct(
        F.col("lang").alias("_index"), F.col("doc_id").alias("_id"),
        F.struct((F.col("n_chars") / 1e6).alias("popularity_score")).alias("_source"))).alias("value"))
    unknown_field = labels.select(F.to_json(F.struct(
        F.lit("en").alias("_index"), F.col("doc_id").alias("_id"),
        F.struct(F.col("quality").alias("quality")).alias("_source"))).alias("value"))
    null_field = labels.select(F.concat(
        F.lit('{"_index": "en", "_id": '), F.col("doc_id").cast("string"),
        F.lit(', "_source": {"popularity_score": null}}')).alias("value"))
    not_json = conv.select(F.concat(F.lit("{"), F.col("text")).alias("value"))
    not_object = conv.select(F.to_json(F.array("role")).alias("value"))
    return good.unionByName(unknown_field).unionByName(null_field).unionByName(not_json).unionByName(not_object)


@register("update_validation", """
SELECT 'valid' AS status, count(*) AS n FROM documents
UNION ALL SELECT 'fail_validate', 2 * (SELECT count(*) FROM labels) + (SELECT count(*) FROM conversations)
UNION ALL SELECT 'bad_json', count(*) FROM conversations
""")
def q_update_validation(spark, sf_dir):
    return updates.validation_counts(updates.validate_updates(_update_messages(spark, sf_dir)))


@register("update_routing", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang AS index,
       CASE WHEN lang IN ('en', 'de') THEN 'north' WHEN lang = 'fr' THEN 'south' ELSE 'missing_index' END
         AS cluster
FROM documents
""")
def q_update_routing(spark, sf_dir):
    checked = updates.validate_updates(_update_messages(spark, sf_dir))
    routed = updates.route_updates(checked.where(F.col("status") == "valid"), CLUSTERS)
    return routed.select("doc_id", "index", "cluster")


@register("update_results", """
WITH cur AS (SELECT d.doc_id, d.n_chars / 1e6 AS old FROM documents d SEMI JOIN labels USING (doc_id)),
upd AS (SELECT d.doc_id, d.n_chars / 1e6 * (1 + 0.5 * coalesce(l.toxic, 0)) AS new
        FROM documents d LEFT JOIN labels l USING (doc_id)),
res AS (SELECT CASE WHEN cur.doc_id IS NULL THEN 'missing'
                    WHEN abs(new - old) <= 0.2 * abs(old) THEN 'noop' ELSE 'updated' END AS counter
        FROM upd LEFT JOIN cur USING (doc_id)),
names AS (SELECT unnest(['updated', 'created', 'noop', 'ok_unknown', 'missing', 'failed']) AS counter)
SELECT names.counter, coalesce(count(res.counter), 0) AS n FROM names LEFT JOIN res USING (counter)
GROUP BY names.counter
""")
def q_update_results(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    current = (docs.join(labels, "doc_id", "left_semi")
               .select("doc_id", (F.col("n_chars") / 1e6).alias("popularity_score")))
    msgs = (docs.join(labels, "doc_id", "left")
            .select(F.to_json(F.struct(F.lit("en").alias("_index"), F.col("doc_id").alias("_id"), F.struct(
                (F.col("n_chars") / 1e6 * (1 + 0.5 * F.coalesce("toxic", F.lit(0)))).alias("popularity_score"))
                .alias("_source"))).alias("value")))
    valid = updates.validate_updates(msgs).where(F.col("status") == "valid")
    applied = updates.apply_updates(valid.withColumn("doc_id", F.col("doc_id").cast("bigint")), current)
    return updates.update_results(updates.as_results(applied))


def _seconds(c):
    """Wall-clock timestamp without zone (read as UTC) → epoch seconds (double),
    independent of the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})") / 1e6


def _samples(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    samples = ev.select("event_type", "event_id", _seconds("ts").alias("t"))
    return counters.running_count(samples, "event_type", "t", "event_id").withColumnRenamed("count", "c")


EMA_SQL = f"""
s AS (SELECT event_type AS k, event_id, epoch_us(ts) / 1e6 AS t,
             CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS DOUBLE) AS c,
             row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
r(k, rn, event_id, t, prev_t, prev_c, v, acc) AS (
    SELECT k, rn, event_id, t, t, c, CAST(NULL AS DOUBLE), true FROM s WHERE rn = 1
    UNION ALL
    SELECT k, rn, event_id, t,
           CASE WHEN per IS NULL THEN prev_t ELSE t END,
           CASE WHEN per IS NULL THEN prev_c ELSE c END,
           CASE WHEN per IS NULL THEN v WHEN v IS NULL THEN per
                ELSE per + (v - per) * pow(1 - {ALPHA}, floor(t - prev_t)) END,
           per IS NOT NULL
    FROM (SELECT s.k, s.rn, s.event_id, s.t, s.c, r.prev_t, r.prev_c, r.v,
                 CASE WHEN s.t - r.prev_t < 1 THEN NULL
                      WHEN s.c - r.prev_c >= 0 THEN (s.c - r.prev_c) / (s.t - r.prev_t)
                      WHEN r.v IS NOT NULL THEN r.v * 1.25 ELSE NULL END AS per
          FROM r JOIN s ON s.k = r.k AND s.rn = r.rn + 1) x)"""


@register("counter_ema", f"""
WITH RECURSIVE {EMA_SQL}
SELECT k AS event_type, event_id, acc AS accepted, round(v, 9) AS ema,
       v IS NOT NULL AND t < prev_t + {MAX_VALID} AS valid
FROM r
""")
def q_counter_ema(spark, sf_dir):
    rows = counters.counter_rate_ema(_samples(spark, sf_dir), "event_type", "t", "c", "event_id",
                                     ALPHA, MAX_VALID)
    return rows.select("event_type", "event_id", "accepted", rnd("ema").alias("ema"), "valid")


@register("load_gate", f"""
WITH RECURSIVE {EMA_SQL},
now AS (SELECT max(epoch_us(ts)) / 1e6 + 1 AS now FROM events),
last AS (SELECT k, arg_max(v, t) AS v, max(t) AS t FROM r WHERE acc GROUP BY k)
SELECT k AS event_type, round(v, 9) AS ema,
       v IS NOT NULL AND (SELECT now FROM now) < t + {MAX_VALID} AND v < {THRESHOLD} AS allowed
FROM last
""")
def q_load_gate(spark, sf_dir):
    rows = counters.counter_rate_ema(_samples(spark, sf_dir), "event_type", "t", "c", "event_id",
                                     ALPHA, MAX_VALID)
    now = table(spark, sf_dir, "events", "ts").agg(F.max(_seconds("ts")) + 1).first()[0]
    gate = counters.load_gate(rows, "event_type", "t", THRESHOLD, now, MAX_VALID)
    return gate.select("event_type", rnd("ema").alias("ema"), "allowed")
