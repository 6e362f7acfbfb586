"""Representative stratified sampling of norm queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage


def page_counts(hits: DataFrame, query_cols: Sequence[str] = ("wikiid", "query"),
                page_col: str = "hit_page_id", wiki_col: str = "wikiid") -> DataFrame:
    """A1: distinct (query, page) pairs per wiki, in two steps (distinct per
    query, then sum per wiki) so no single task holds a wiki's distinct set."""
    per_query = (hits.groupBy(*query_cols)
                 .agg(F.count_distinct(page_col).alias("num_hit_page_ids")))
    return per_query.groupBy(wiki_col).agg(F.sum("num_hit_page_ids").cast("bigint").alias("num_hit_page_ids"))


def session_counts(df: DataFrame, keys: Sequence[str] = ("wikiid", "norm_query_id"),
                   session_col: str = "session_id") -> DataFrame:
    """A2: distinct sessions per key (two-level aggregate with partial combine)."""
    return df.groupBy(*keys).agg(F.count_distinct(session_col).alias("num_sessions"))


def quantile_edges(df: DataFrame, by: str, col: str, num_buckets: int = 100) -> DataFrame:
    """Approximate right edges of ``num_buckets`` equal-count buckets
    per ``by`` value: percentiles k/N (k=1..N-1) with relative error 1/(10N)
    and a final +inf edge.  One grouped ``percentile_approx`` job for all
    groups (mergeable sketches, no per-group driver loop)."""
    probs = [k / num_buckets for k in range(1, num_buckets)]
    pct = F.percentile_approx(F.col(col).cast("double"), probs, 10 * num_buckets)
    return df.groupBy(by).agg(
        F.concat(pct, F.array(F.lit(float("inf")))).alias("edges"))


def exact_quantile_edges(counts: DataFrame, by: str, col: str, num_buckets: int) -> DataFrame:
    """Exact lower quantile edges: the edge for k/N is the smallest value whose cumulative
    count reaches k/N of the group.  Returns (by, edges array<double>) with a final +inf edge.

    Distributed selection: the histogram is cut into ranges of (group, value) of about equal
    size, which are written once; a range's count before it comes from one row a range and group, and only
    inside a range are values counted up in order.  So a group of any number of distinct values is
    never in one task."""
    hist = counts.groupBy(by, col).agg(F.count(F.lit(1)).alias("_c"))
    ranged = cut_lineage(hist.repartitionByRange(F.col(by), F.col(col)).withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy(by, "_part").agg(F.sum("_c").alias("_pc"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.withColumn("_off", F.coalesce(F.sum("_pc").over(before), F.lit(0)))
               .withColumn("_tot", F.sum("_pc").over(Window.partitionBy(by)))
               .select(F.col(by).alias("_g"), F.col("_part").alias("_p"), "_off", "_tot"))
    inside = Window.partitionBy("_part", by).orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    cum = ranged.withColumn("_in", F.sum("_c").over(inside)) \
        .join(offsets, F.col(by).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p"))) \
        .withColumn("_cum", F.col("_off") + F.col("_in"))
    ks = F.array(*[F.lit(k) for k in range(1, num_buckets)])
    reached = F.exists(ks, lambda k: (F.col("_cum") * num_buckets >= k * F.col("_tot")) &
                       ((F.col("_cum") - F.col("_c")) * num_buckets < k * F.col("_tot")))
    first_hits = cum.where(reached).select(by, F.col(col).cast("double").alias("_e"))
    return (first_hits.groupBy(by)
            .agg(F.array_sort(F.collect_set("_e")).alias("_edges"))
            .select(by, F.concat("_edges", F.array(F.lit(float("inf")))).alias("edges")))


def sample_queries(df: DataFrame, samples_per_wiki: int, seed: int = 54321,
                   key_col: str = "norm_query_id", num_buckets: int = 100,
                   query_cols: Sequence[str] = ("wikiid", "query"), page_col: str = "hit_page_id",
                   exact_strata: bool = True) -> tuple[DataFrame, DataFrame]:
    """M2: representative sample of ``key_col`` values per wiki.

    fraction(wiki) = min(1, samples_per_wiki / distinct (query, page) pairs).
    Keys are stratified by their session count (bucket = first right edge >=
    count), and each (wiki, stratum) keeps round(fraction × size) keys with
    the smallest ``md5(seed/wiki/key)`` — repeatable and exact per stratum.
    Sampled keys are semi-joined back.  Returns (counts per wiki, sample).
    """
    counts = page_counts(df, query_cols, page_col)
    ratio = F.lit(float(samples_per_wiki)) / F.col("num_hit_page_ids")
    frac = counts.select("wikiid", F.when(F.col("num_hit_page_ids") > 0, F.least(F.lit(1.0), ratio))
                         .otherwise(F.lit(1.0)).alias("fraction"))
    keys = session_counts(df, ("wikiid", key_col))
    if exact_strata:
        edges = exact_quantile_edges(keys, "wikiid", "num_sessions", num_buckets)
    else:
        edges = quantile_edges(keys, "wikiid", "num_sessions", num_buckets)
    # edges and fractions are one small row per wiki; the join is planned by size (AQE).
    strata = (keys.join(edges, "wikiid").join(frac, "wikiid")
              .withColumn("stratum", F.size(F.filter("edges", lambda e: e < F.col("num_sessions")))))
    # Rank inside a stratum by md5 without sorting a whole stratum in one task:
    # totals per (wiki, stratum, md5 prefix) give each prefix bucket's offset
    # (a small table), and the row number only runs inside one prefix bucket.
    hashed = (strata
              .withColumn("_h", F.md5(F.concat_ws("/", F.lit(str(seed)), "wikiid", F.col(key_col).cast("string"))))
              .withColumn("_b", F.substring("_h", 1, 3)))
    sk = ["wikiid", "stratum"]
    btot = hashed.groupBy(*sk, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*sk).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (btot.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
               .withColumn("_n", F.sum("_bn").over(Window.partitionBy(*sk))).drop("_bn"))
    inner = Window.partitionBy(*sk, "_b").orderBy("_h", key_col)
    chosen = (hashed.join(offsets, [*sk, "_b"])
              .withColumn("_quota", F.floor(F.col("fraction") * F.col("_n") + 0.5))
              .withColumn("_rn", F.col("_off") + F.row_number().over(inner))
              .where(F.col("_rn") <= F.col("_quota"))
              .select("wikiid", key_col))
    return counts, df.join(chosen, ["wikiid", key_col], "left_semi")
