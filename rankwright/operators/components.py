"""Connected components by alternating large-star and small-star steps.

Each step rewires every edge towards the least vertex known around it; the two steps
together keep connectivity and end in one star per component whose centre is its least
vertex.  The number of rounds grows with the logarithm of the component's size also on
long chains, and the loop runs until nothing changes: there is no round cap.

A step is an aggregate (least neighbour, partial in the map tasks) joined back to the
edges, so a vertex with very many edges is pre-aggregated in the first and split by
adaptive skew handling in the second.  Rounds are cut with reliable checkpoints, and a round's
files go when the next one is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, retire


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*edges.columns))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    both = edges.select(*keys, F.col("a").alias("x"), F.col("b").alias("y")).union(
        edges.select(*keys, F.col("b").alias("x"), F.col("a").alias("y")))
    least = both.groupBy(*keys, "x").agg(F.min("y").alias("m")).withColumnRenamed("x", "b")
    return edges.join(least, [*keys, "b"]).select(*keys, "a", F.least("b", "m").alias("b")).distinct()


def _small_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    least = edges.groupBy(*keys, "a").agg(F.min("b").alias("m"))
    moved = edges.join(least, [*keys, "a"]).where(F.col("b") != F.col("m")) \
        .select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(*keys, "a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, u: str, v: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, vertex, component)`` of all vertices that have an edge to another.

    Components are found within equal ``keys``; ``component`` is the least vertex."""
    keys = list(keys)
    now = cut_lineage(edges.where(F.col(u) != F.col(v)).select(
        *keys, F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).distinct())
    print_now = _fingerprint(now)
    while print_now[0]:
        then = cut_lineage(_small_star(_large_star(now, keys), keys))
        print_then = _fingerprint(then)
        done, before = print_then == print_now, now
        now, print_now = then, print_then
        retire(before)
        if done:
            break
    roots = now.select(*keys, F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
    return now.select(*keys, F.col("a").alias("vertex"), F.col("b").alias("component")).union(roots)
