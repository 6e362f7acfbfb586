"""Query grouping by result-set similarity.

Queries with equal page sets are one vertex (their set); similar sets are found with an
exact prefix-filtered set-similarity join, and groups are the connected components of
the sets (``components``: rounds grow with the logarithm, no cap).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import normalise_query
from ..session import cut_lineage
from . import components
from .clicks import session_gate


def top_hits(hits: DataFrame, n: int = 5, keys: Sequence[str] = ("wikiid", "query"),
             page_col: str = "hit_page_id") -> DataFrame:
    """O2: the ``n`` most displayed pages per query (count desc, page asc).

    Aggregates (key, page) first with a map-side partial, then a rank-limited
    window (Spark pushes ``row_number <= n`` below the exchange as a group limit).
    """
    k = list(keys)
    counts = hits.groupBy(*k, page_col).agg(F.count(F.lit(1)).alias("n_shown"))
    w = Window.partitionBy(*k).orderBy(F.col("n_shown").desc(), F.col(page_col).asc())
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))


def hit_sets(top: DataFrame, keys: Sequence[str] = ("wikiid", "query"),
             page_col: str = "hit_page_id") -> DataFrame:
    """Sorted distinct page set per query."""
    return top.groupBy(*keys).agg(F.array_sort(F.collect_set(page_col)).alias("hit_page_ids"))


# Sets of a group that share a frequent page are compared in blocks of this many.
BLOCK = 1000


def _prefix_len(size: F.Column, threshold: float) -> F.Column:
    # Sets with J(A, B) > t share more than t|A| tokens, so one of them is among the first
    # |A| - floor(t|A|) tokens of a common global order.
    return size - F.floor(F.lit(threshold) * size + F.lit(1e-9))


def set_members(sets: DataFrame, group_cols: Sequence[str], item_col: str, set_col: str) -> DataFrame:
    """Each item with a non-empty set, and the id of its set (``_sid``, equal for equal sets)."""
    members = sets.where(F.size(set_col) > 0).select(
        *group_cols, item_col, F.array_sort(F.array_distinct(set_col)).alias("_set"))
    return members.withColumn("_sid", F.array_join(F.col("_set").cast("array<string>"), ","))


def similar_sets(members: DataFrame, threshold: float, group_cols: Sequence[str]) -> DataFrame:
    """Pairs ``sa < sb`` of distinct set ids of one group with Jaccard > ``threshold``.

    Steps: (1) order tokens by ascending document frequency inside the group and keep
    each set's prefix; (2) candidate pairs = prefix self-join on (group, token) of sets whose lengths and whose
    places of the token in their order still allow the similarity; a token's sets are joined block
    by block (``BLOCK``), so no task holds all pairs of a frequent one; (3) verify the exact Jaccard similarity."""
    if not threshold > 0:
        raise ValueError("threshold must be > 0 (pairs sharing nothing are never similar)")
    g = list(group_cols)
    distinct_sets = members.select(*g, "_sid", "_set").dropDuplicates([*g, "_sid"])
    tokens = distinct_sets.select(*g, "_sid", F.size("_set").alias("_len"), F.explode("_set").alias("_tok"))
    freq = tokens.groupBy(*g, "_tok").agg(F.count(F.lit(1)).alias("_df"))
    ordered = tokens.join(freq, [*g, "_tok"])
    by_rarity = Window.partitionBy(*g, "_sid").orderBy(F.col("_df").asc(), F.col("_tok").asc())
    prefix = (ordered.withColumn("_r", F.row_number().over(by_rarity))
              .where((F.col("_r") <= _prefix_len(F.col("_len"), threshold)) & (F.col("_df") > 1))
              .select(*g, "_sid", "_tok", "_len", "_r"))
    shared = prefix.groupBy(*g, "_tok").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1") \
        .select(*g, "_tok", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    dealt = prefix.join(shared, [*g, "_tok"]).withColumn("_own", F.pmod(F.xxhash64("_sid"), F.col("_blocks")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))) \
        .select(*g, "_tok", "_sid", "_len", "_r", "_own", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"))
    a, b = dealt.alias("a"), dealt.alias("b")
    short, long = F.least("a._len", "b._len"), F.greatest("a._len", "b._len")
    common = 1 + F.least(F.col("a._len") - F.col("a._r"), F.col("b._len") - F.col("b._r"))
    cand = (a.join(b, [*g, "_tok", "_lo", "_hi"])
            .where((F.col("a._sid") < F.col("b._sid")) & ((F.col("a._own") != F.col("b._own")) | (F.col("_lo") == F.col("_hi")))
                   & (short > threshold * long) & (common * (1 + threshold) > threshold * (short + long) - 1e-9))
            .select(*g, F.col("a._sid").alias("sa"), F.col("b._sid").alias("sb"))
            .dropDuplicates())
    sa = distinct_sets.select(*g, F.col("_sid").alias("sa"), F.col("_set").alias("set_a"))
    sb = distinct_sets.select(*g, F.col("_sid").alias("sb"), F.col("_set").alias("set_b"))
    inter = F.size(F.array_intersect("set_a", "set_b"))
    return (cand.join(sa, [*g, "sa"]).join(sb, [*g, "sb"])
            .withColumn("intersection", inter)
            .withColumn("union", F.size("set_a") + F.size("set_b") - F.col("intersection"))
            .withColumn("jaccard", F.col("intersection") / F.col("union"))
            .where(F.col("jaccard") > threshold)
            .select(*g, "sa", "sb", "intersection", "union", "jaccard"))


def query_similarity(sets: DataFrame, threshold: float = 0.5,
                     group_cols: Sequence[str] = ("wikiid", "norm_query"),
                     item_col: str = "query", set_col: str = "hit_page_ids") -> DataFrame:
    """All pairs (a < b) of items in the same group with Jaccard > threshold.

    ``threshold`` must be > 0.  This report expands similar sets to their items; grouping
    works on the sets alone (:func:`similar_sets`)."""
    g = list(group_cols)
    # The set table is read five times below; materialise it once (reliably).
    members = cut_lineage(set_members(sets, g, item_col, set_col))
    verified = similar_sets(members, threshold, g)
    ma = members.select(*g, F.col("_sid").alias("sa"), F.col(item_col).alias("qa"))
    mb = members.select(*g, F.col("_sid").alias("sb"), F.col(item_col).alias("qb"))
    cross = (verified.join(ma, [*g, "sa"]).join(mb, [*g, "sb"])
             .select(*g, F.least("qa", "qb").alias(f"{item_col}_a"),
                     F.greatest("qa", "qb").alias(f"{item_col}_b"),
                     "intersection", "union", "jaccard"))
    sizes = members.select(*g, F.col("_sid").alias("sa"), F.size("_set").alias("_n")).dropDuplicates([*g, "sa"])
    same = (ma.join(mb.withColumnRenamed("sb", "sa"), [*g, "sa"])
            .where(F.col("qa") < F.col("qb"))
            .join(sizes, [*g, "sa"])
            .select(*g, F.col("qa").alias(f"{item_col}_a"), F.col("qb").alias(f"{item_col}_b"),
                    F.col("_n").alias("intersection"), F.col("_n").alias("union"),
                    F.lit(1.0).alias("jaccard")))
    return cross.unionByName(same)


def connected_components(vertices: DataFrame, edges: DataFrame, group_cols: Sequence[str],
                         vertex_col: str, src: str, dst: str) -> DataFrame:
    """Component label ``group_query`` (minimum vertex) per vertex, inside each group."""
    g = list(group_cols)
    linked = components.connected_components(edges, src, dst, g) \
        .withColumnRenamed("vertex", vertex_col).withColumnRenamed("component", "group_query")
    return (vertices.select(*g, vertex_col).distinct()
            .join(linked, [*g, vertex_col], "left")
            .withColumn("group_query", F.coalesce("group_query", vertex_col)))


def group_items(sets: DataFrame, threshold: float, group_cols: Sequence[str], item_col: str,
                set_col: str = "hit_page_ids") -> DataFrame:
    """``(*group_cols, item, group_query)`` of every item with a non-empty set: the smallest
    item of the component of its set.  No pair of items is ever formed."""
    g = list(group_cols)
    members = cut_lineage(set_members(sets, g, item_col, set_col))
    comps = components.connected_components(similar_sets(members, threshold, g), "sa", "sb", g)
    named = members.select(*g, item_col, "_sid").join(
        comps.withColumnRenamed("vertex", "_sid"), [*g, "_sid"], "left") \
        .withColumn("_c", F.coalesce("component", "_sid"))
    canonical = named.groupBy(*g, "_c").agg(F.min(item_col).alias("group_query"))
    return named.join(canonical, [*g, "_c"]).select(*g, item_col, "group_query")


def group_queries(df: DataFrame, threshold: float = 0.5, min_sessions: int = 10, top_n: int = 5,
                  norm_query_col: str | None = "norm_query") -> DataFrame:
    """M1: attach ``group_query`` (canonical = smallest query of the component)
    and ``norm_query_id`` (xxhash64 of wiki, norm query, canonical query).

    Input: hit rows (wikiid, query, session_id, hit_page_id, ...).  If
    ``norm_query_col`` is missing, it is computed with :func:`normalise_query`.
    Gate ≥ ``min_sessions`` sessions per (wikiid, norm_query) → top-N pages →
    Jaccard > threshold edges → components → join back → gate per final group.
    """
    if norm_query_col is None or norm_query_col not in df.columns:
        df = df.withColumn("norm_query", normalise_query("query", "wikiid"))
    elif norm_query_col != "norm_query":
        df = df.withColumnRenamed(norm_query_col, "norm_query")
    g = ["wikiid", "norm_query"]
    # Read three times below (queries, top hits, join back): keep it once.
    gated = cut_lineage(session_gate(df, g, min_sessions))
    sets = hit_sets(top_hits(gated, top_n, keys=[*g, "query"]), keys=[*g, "query"])
    comps = cut_lineage(group_items(sets, threshold, g, "query"))
    grouped = (gated.join(comps, [*g, "query"], "left")
               .withColumn("group_query", F.coalesce("group_query", "query"))
               .withColumn("norm_query_id", F.xxhash64("wikiid", "norm_query", "group_query")))
    return session_gate(grouped, ["wikiid", "norm_query_id"], min_sessions)
