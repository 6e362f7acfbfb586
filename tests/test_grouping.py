import itertools

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankwright.functions.columns import at_least_n_distinct, at_least_n_distinct_over
from rankwright.operators import components, grouping


@pytest.mark.parametrize("hits, expected", [
    ([[11, 12, 13], [12, 13, 14, 15, 16, 17, 18, 19]], [0, 1]),                  # 2 of 9 shared
    ([[1, 5, 9, 20], [1, 5, 9], [40, 41, 42]], [0, 0, 2]),                        # 3 of 4 shared, one apart
    ([[1, 2, 3, 4, 5, 6, 7, 8], [5, 6, 7, 8, 1, 2, 3], [90], [90], [90, 91]], [0, 0, 2, 2, 4]),  # 1 of 2 is not over 0.5
    ([[7, 8, 9, 10], [8, 9, 10, 7], [10, 9, 8, 7, 6], [9, 8, 7, 6, 5]], [0, 0, 0, 0]),    # linked through the third
    ([[], [3], [], [3, 3]], [0, 1, 2, 1]),                                          # empty sets stay alone
])
def test_query_groups_cases(spark, hits, expected):
    sets = spark.createDataFrame([("w", "n", str(i), h) for i, h in enumerate(hits)],
                                 "wikiid string, norm_query string, query string, hit_page_ids array<int>")
    edges = grouping.query_similarity(sets, 0.5)
    comps = grouping.connected_components(sets, edges, ["wikiid", "norm_query"], "query", "query_a", "query_b")
    label = {r.query: r.group_query for r in comps.collect()}
    # same expected group <=> same component
    for i, j in itertools.combinations(range(len(hits)), 2):
        assert (label[str(i)] == label[str(j)]) == (expected[i] == expected[j])


def test_jaccard_matches_naive(spark):
    rng = np.random.default_rng(0)
    m = rng.random((200, 100)) < 0.3
    sets = [sorted(np.nonzero(row)[0].tolist()) for row in m]
    df = spark.createDataFrame([("w", "n", f"q{i:03d}", s) for i, s in enumerate(sets)],
                               "wikiid string, norm_query string, query string, hit_page_ids array<int>")
    t = 0.2
    got = {(r.query_a, r.query_b): r.jaccard for r in grouping.query_similarity(df, t).collect()}
    want = {}
    for i, j in itertools.combinations(range(200), 2):
        a, b = set(sets[i]), set(sets[j])
        if a and b:
            jac = len(a & b) / len(a | b)
            if jac > t:
                want[(f"q{i:03d}", f"q{j:03d}")] = jac
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_chain_components(spark):
    # a long chain needs several propagation rounds
    edges = spark.createDataFrame([("w", "n", f"{i:02d}", f"{i + 1:02d}") for i in range(30)],
                                  "wikiid string, norm_query string, query_a string, query_b string")
    verts = spark.createDataFrame([("w", "n", f"{i:02d}") for i in range(32)],
                                  "wikiid string, norm_query string, query string")
    comps = grouping.connected_components(verts, edges, ["wikiid", "norm_query"], "query", "query_a", "query_b")
    label = {r.query: r.group_query for r in comps.collect()}
    assert {label[f"{i:02d}"] for i in range(31)} == {"00"}
    assert label["31"] == "31"


@pytest.mark.parametrize("length", [400, 10000])
def test_shuffled_chains_always_finish(spark, length):
    names = np.random.default_rng(length).permutation(length)
    edges = spark.createDataFrame([("w", int(names[i]), int(names[i + 1])) for i in range(length - 1)],
                                  "wikiid string, a long, b long")
    comps = components.connected_components(edges, "a", "b", ["wikiid"])
    assert comps.count() == length
    assert [r.component for r in comps.select("component").distinct().collect()] == [0]


def test_many_queries_of_one_set_form_no_pairs(spark):
    sets = spark.range(100_000).select(F.lit("w").alias("wikiid"), F.lit("n").alias("norm_query"),
                                       F.format_string("q%06d", "id").alias("query"),
                                       F.array(F.lit(3), F.lit(1), F.lit(2)).alias("hit_page_ids"))
    found = grouping.group_items(sets, 0.5, ["wikiid", "norm_query"], "query").groupBy("group_query").count().collect()
    assert [tuple(r) for r in found] == [("q000000", 100_000)]


def test_at_least_n_distinct(spark):
    df = spark.createDataFrame([("eu", "x", "p"), ("eu", "x", "q"), ("eu", "x", "r"), ("eu", "y", "p"),
                                ("us", "x", "p"), ("us", "x", "p"), ("us", "x", None), ("us", "z", None)],
                               "a string, b string, c string")
    per_key = {("eu", "x"): 3, ("eu", "y"): 1, ("us", "x"): 1, ("us", "z"): 0}
    expect = sorted([(*r, per_key[r[0], r[1]] >= 2) for r in map(tuple, df.collect())], key=str)
    w = Window.partitionBy("a", "b")
    res = df.withColumn("z", at_least_n_distinct("c", 2, over=w)).collect()
    assert sorted(map(tuple, res), key=str) == expect
    res = df.withColumn("z", at_least_n_distinct_over("c", 2, ["a", "b"])).collect()
    assert sorted(map(tuple, res), key=str) == expect


@pytest.mark.parametrize("limit, values, expected", [
    (3, ["a", "b", "c"], True), (3, ["a", "b", "b", "a"], False), (2, ["x"], False),
    (1, ["x", "x"], True), (4, ["k", "l", "m", "n", "o", "k"], True), (1, [], False),
])
def test_at_least_n_distinct_grouped(spark, limit, values, expected):
    df = spark.createDataFrame([("k", v) for v in values] + [("k", None)], "k string, v string")
    got = df.groupBy("k").agg(at_least_n_distinct("v", limit).alias("ok")).first().ok
    assert got == expected


def test_sets_that_share_one_page_finish(spark):
    """100,000 distinct sets around one page; the near pairs among them are found."""
    n = 100_000
    sets = spark.range(n).select(
        F.lit("w").alias("wikiid"), F.lit("n").alias("norm_query"), F.col("id").cast("string").alias("query"),
        F.array(F.lit(-1).cast("long"), F.col("id"), F.floor(F.col("id") / 2) + 10 * n,
                F.when(F.col("id") % 1000 < 2, F.floor(F.col("id") / 2) + 20 * n).otherwise(F.col("id") + 30 * n)).alias("hit_page_ids"))
    got = grouping.group_items(sets, 0.5, ["wikiid", "norm_query"], "query").groupBy("group_query").count().where("count > 1")
    # 2k and 2k + 1 share three pages of five where 2k % 1000 is 0, else two of six
    assert sorted((int(r.group_query), r["count"]) for r in got.collect()) == [(k, 2) for k in range(0, n, 1000)]


def test_blocks_and_filters_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(grouping, "BLOCK", 7)
    rng = np.random.default_rng(12)
    rows = sorted({tuple(sorted(set(rng.choice([0, 0, 1, 2, *range(3, 14)], rng.integers(1, 7)).tolist()))) for _ in range(150)})
    df = spark.createDataFrame([("w", "n", f"q{i}", list(r)) for i, r in enumerate(rows)],
                               "wikiid string, norm_query string, query string, hit_page_ids array<int>")
    for t in (0.3, 0.5, 0.75):
        got = {(r.query_a, r.query_b): r.jaccard for r in grouping.query_similarity(df, t).collect()}
        want = {}
        for (i, a), (j, b) in itertools.combinations(enumerate(rows), 2):
            x = len(set(a) & set(b)) / len(set(a) | set(b))
            if x > t:
                want[min(f"q{i}", f"q{j}"), max(f"q{i}", f"q{j}")] = x
        assert got == pytest.approx(want)
