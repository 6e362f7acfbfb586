"""Histogram boosting: gradients, splits, jobs against numpy, node tables, search."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rankwright.operators import boosting, rank_model
from rankwright.operators.boosting import Block, Spec


def block(rng, queries=12, features=4, bins=9, number=0):
    sizes = rng.integers(1, 40, queries)
    n = int(sizes.sum())
    return Block(number, rng.integers(0, bins, (n, features)).astype(np.uint8), rng.integers(0, 5, n).astype(float),
                 np.concatenate([[0], np.cumsum(sizes)]), rng.integers(0, 3, queries), [f"w{i % 2}" for i in range(queries)])


def brute_lambdas(scores, b):
    g, h = np.zeros(len(scores)), np.zeros(len(scores))
    for a, z in zip(b.starts, b.starts[1:]):
        rows = sorted(range(a, z), key=lambda i: (-scores[i], b.labels[i], i))
        rank = {i: r for r, i in enumerate(rows)}

        def discount(i):
            return 1 / math.log2(rank[i] + 2) if rank[i] < 10 else 0.0

        ideal = sum((2 ** x - 1) / math.log2(r + 2) for r, x in enumerate(sorted(b.labels[a:z], reverse=True)[:10]))
        for i in range(a, z):
            for j in range(a, z):
                if ideal and b.labels[i] > b.labels[j]:
                    change = abs((2 ** b.labels[i] - 2 ** b.labels[j]) * (discount(i) - discount(j))) / ideal
                    p = 1 / (1 + math.exp(scores[i] - scores[j]))
                    g[i] -= p * change
                    g[j] += p * change
                    h[i] += p * (1 - p) * change
                    h[j] += p * (1 - p) * change
    return g, h


def test_gradients_equal_all_pairs():
    rng = np.random.default_rng(1)
    b = block(rng)
    for scores in (np.zeros(len(b.labels)), rng.normal(size=len(b.labels)), rng.integers(0, 3, len(b.labels)).astype(float)):
        g, h = boosting.lambdas(scores, b)
        want_g, want_h = brute_lambdas(scores, b)
        assert np.allclose(g / boosting.FIXED, want_g, atol=1e-6) and np.allclose(h / boosting.FIXED, want_h, atol=1e-6)


def brute_split(bins, g, h, weight):
    """Best (gain, feature, bin) by trying every threshold on the rows."""
    def part(keep):
        return (g[keep].sum() / boosting.FIXED) ** 2 / (h[keep].sum() / boosting.FIXED + 1.0)
    best = (0.0, -1, 0)
    for f in range(bins.shape[1]):
        for b in range(8):
            left = bins[:, f] <= b
            hl, hr = (h[k].sum() / boosting.FIXED for k in (left, ~left))
            if hl >= weight and hr >= weight and min(hl, hr) > 0:
                gain = part(left) + part(~left) - part(np.ones(len(g), bool))
                if gain > best[0] + 1e-12:
                    best = (gain, f, b)
    return best


def test_splits_equal_a_numpy_grower():
    rng = np.random.default_rng(2)
    for weight in (0.0, 0.5, 2.0):
        b = block(rng)
        g, h = boosting.lambdas(rng.normal(size=len(b.labels)), b)
        spec = Spec(1, 0.3, 3, weight)
        tree, open_nodes = boosting.Tree.of_depth(3), [1]
        while open_nodes and max(open_nodes) < 8:
            sums = boosting.level_sums(b, g, h, tree, open_nodes, np.arange(4), None, 9)
            found = boosting.best_splits(sums, weight)
            at = tree.leaves(b.bins)
            for node, s in zip(open_nodes, found):
                rows = at == node
                want = brute_split(b.bins[rows], g[rows], h[rows], weight)
                assert s[0] == pytest.approx(want[0], abs=1e-9)
                if want[0] > boosting.MIN_GAIN:
                    assert (s[1], s[2]) == want[1:]
                assert s[3] == g[rows].sum() and s[4] == h[rows].sum()
            open_nodes = boosting.extend(tree, spec, dict(zip(open_nodes, found)))


def ranking_rows(spark, queries=60, seed=3, signal=True):
    rng = np.random.default_rng(seed)
    rows = []
    for q in range(queries):
        for i in range(int(rng.integers(5, 30))):
            x = rng.normal(size=4)
            label = int(np.clip(round(1.5 + (x[0] * x[1] + 0.5 * x[2] if signal else 0) + 0.3 * rng.normal()), 0, 4))
            rows.append((f"w{q % 3}", f"q{q}", i, q % 3, label, *map(float, np.round(x, 2))))
    df = spark.createDataFrame(rows, "wikiid string, query string, hit_page_id int, fold int, label int, a double, b double, c double, d double")
    return df.withColumn("features", array_to_vector(F.array("a", "b", "c", "d"))).drop("a", "b", "c", "d")


def same_trees(one, two):
    assert len(one) == len(two)
    for a, b in zip(one, two):
        assert (a.feature == b.feature).all() and (a.bin == b.bin)[a.feature >= 0].all() and np.allclose(a.value, b.value, atol=1e-12)


def test_jobs_by_level_equal_training_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP_SCORES_EVERY", 2)
    df = ranking_rows(spark, 30)
    edges = boosting.bin_edges(df, "features", 16)
    specs = [Spec(3, 0.3, 3, 0.5, held_out=0), Spec(2, 0.2, 2, 1.0, 0.7, 0.5, 5, 1), Spec(3, 0.5, 1)]
    blocks, n = boosting.layout(df, edges, "label", "features", ("wikiid", "query"), "fold", block_values=400)
    assert n > 3
    whole, m1 = boosting.fit_models(blocks, n, specs, 16, 2, whole=True)
    levels, m2 = boosting.fit_models(blocks, n, specs, 16, 2)
    for a, b in zip(whole, levels):
        same_trees(a, b)
    means = [sorted((r.model, r.round, r.test, round(r.ndcg, 9)) for r in rank_model._means(m).collect()) for m in (m1, m2)]
    assert means[0] == means[1] and {(r[0], r[1]) for r in means[0]} == {(0, 2), (0, 3), (1, 2), (2, 2), (2, 3)}


def softmax_ranker(x, labels, starts, rounds, depth, eta=0.3):
    """Listwise softmax boosting with the same trees, for comparison."""
    b = Block(0, x, labels, starts, np.zeros(len(starts) - 1), [""] * (len(starts) - 1))
    scores, trees = np.zeros(len(labels)), []
    query = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    gain = 2.0 ** labels - 1
    target = gain / np.maximum(np.bincount(query, gain), 1e-9)[query]
    for _ in range(rounds):
        e = np.exp(scores - np.maximum.reduceat(scores, starts[:-1])[query])
        p = e / np.bincount(query, e)[query]
        g, h = np.rint((p - target) * boosting.FIXED), np.rint(p * (1 - p) * boosting.FIXED)
        tree, open_nodes = boosting.Tree.of_depth(depth), [1]
        for _ in range(depth):
            if open_nodes:
                found = boosting.best_splits(boosting.level_sums(b, g, h, tree, open_nodes, np.arange(x.shape[1]), None, 64), 0.0)
                open_nodes = boosting.extend(tree, Spec(1, eta, depth, 0.0), dict(zip(open_nodes, found)))
        scores += tree.value[tree.leaves(x)]
        trees.append(tree)
    return trees


def long_lists(seed, queries=120):
    """Lists of about a hundred documents with few good ones, in three folds."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(60, 140, queries)
    x = rng.normal(size=(int(sizes.sum()), 6))
    worth = x[:, 0] * x[:, 1] + x[:, 2] + 0.5 * np.abs(x[:, 3]) + 0.5 * rng.normal(size=len(x))
    labels = np.digitize(worth, np.quantile(worth, [0.6, 0.8, 0.92, 0.98])).astype(float)
    marks = np.linspace(0, 1, 64)[1:-1]
    bins = np.stack([np.searchsorted(np.quantile(x[:, j], marks), x[:, j]) for j in range(6)], 1).astype(np.uint8)
    return Block(0, bins, labels, np.concatenate([[0], np.cumsum(sizes)]), np.arange(queries) % 3, ["w"] * queries)


def test_lambdas_beat_the_softmax_on_held_out_folds():
    mean = {"lambda": [], "softmax": []}
    for seed in (0, 1):
        whole = long_lists(seed)
        for fold in range(3):
            trees, _ = boosting.train_here([whole], Spec(40, 0.3, 4, 0.1, held_out=fold), 64, 0)
            train, test = whole.queries(whole.folds != fold)[0], whole.queries(whole.folds == fold)[0]
            for name, made in (("lambda", trees), ("softmax", softmax_ranker(train.bins, train.labels, train.starts, 40, 4))):
                mean[name].append(boosting.ndcg(sum(t.value[t.leaves(test.bins)] for t in made), test).mean())
    assert np.mean(mean["lambda"]) > np.mean(mean["softmax"]) > 0.8


def test_min_child_weight_is_a_hessian_sum(spark):
    df = ranking_rows(spark, 20)
    model = rank_model.fit_ranker(df, {"num_rounds": 1, "max_depth": 3, "min_child_weight": 1e9})
    assert len(model.nodes) == 1 and model.nodes[0][2] is None
    # far more rows than hessian: a row count of 5 would allow splits
    total = sum(boosting.lambdas(np.zeros(len(b.labels)), b)[1].sum() for b in
                (boosting._block(r.asDict()) for r in boosting.layout(
                    df, boosting.bin_edges(df, "features", 256), "label", "features", ("wikiid", "query"))[0].collect())) / boosting.FIXED
    assert len(rank_model.fit_ranker(df, {"num_rounds": 1, "max_depth": 3, "min_child_weight": total * 0.51}).nodes) == 1
    assert len(rank_model.fit_ranker(df, {"num_rounds": 1, "max_depth": 3, "min_child_weight": total * 0.1}).nodes) > 1


def test_colsample_draws_features_a_tree():
    spec = Spec(1, colsample=0.5, seed=4)
    drawn = [tuple(boosting.drawn_features(spec, r, 10)) for r in range(30)]
    assert all(len(set(d)) == 5 for d in drawn) and len(set(drawn)) > 5
    assert boosting.drawn_features(Spec(1), 0, 3).tolist() == [0, 1, 2]


def test_node_table_scores_as_the_trees_and_in_sql(spark, tmp_path):
    df = ranking_rows(spark, 25).withColumn("value", F.lit("clash")).withColumn("node", F.lit(1))
    model = rank_model.fit_ranker(df, {"num_rounds": 5, "max_depth": 3, "max_bin": 32}, eval_df=df, eval_every=2)
    assert [(r, s) for r, s, _ in model.history] == [(2, "train"), (2, "test"), (4, "train"), (4, "test")]
    model.save(str(tmp_path / "m"))
    again = rank_model.RankModel.load(str(tmp_path / "m"))
    assert again.nodes == model.nodes and again.history == model.history
    scored = rank_model.score(df, again)
    assert set(df.columns) < set(scored.columns)
    model.table(spark).createOrReplaceTempView("stored_nodes")
    df.select("query", "hit_page_id", F.col("features")).createOrReplaceTempView("stored_rows")
    from pyspark.ml.functions import vector_to_array
    df.select("query", "hit_page_id", vector_to_array("features").alias("x")).createOrReplaceTempView("stored_rows")
    walked = spark.sql("""
        WITH RECURSIVE at AS (
          SELECT r.query, r.hit_page_id, r.x, n.round, 1 AS node FROM stored_rows r, (SELECT DISTINCT round FROM stored_nodes) n
          UNION ALL
          SELECT a.query, a.hit_page_id, a.x, a.round, CASE WHEN a.x[n.feature] <= n.threshold THEN n.left ELSE n.right END
          FROM at a JOIN stored_nodes n ON n.round = a.round AND n.node = a.node WHERE n.left IS NOT NULL)
        SELECT query, hit_page_id, sum(value) AS p FROM at JOIN stored_nodes n USING (round, node) WHERE n.left IS NULL GROUP BY ALL""")
    got = {(r.query, r.hit_page_id): r.prediction for r in scored.collect()}
    for r in walked.collect():
        assert got[r.query, r.hit_page_id] == pytest.approx(r.p, abs=1e-12)


def test_odd_rows(spark):
    rows = [("w", "q", 1, None, [1.0, float("nan")]), ("w", "q", 2, 3, [2.0, 1.0]), (None, "q", 1, 1, [0.0, 0.0]), ("w", None, 1, 2, [5.0, 1.0]),
            ("w", None, 2, 0, [4.0, 1.0])]
    df = spark.createDataFrame(rows, "wikiid string, query string, hit_page_id int, label int, x array<double>") \
        .withColumn("features", array_to_vector("x"))
    model = rank_model.fit_ranker(df, {"num_rounds": 2, "max_depth": 2, "min_child_weight": 0})
    got = rank_model.score(df, model).collect()
    assert len(got) == 5 and all(math.isfinite(r.prediction) for r in got)
    with pytest.raises(ValueError):
        rank_model.cross_validate(df.withColumn("fold", F.lit(0)), {"num_rounds": 1}, num_folds=2).collect()


def test_search_trains_all_candidates_of_a_stage_together(spark, monkeypatch):
    df = ranking_rows(spark, 30)
    calls = []
    real = boosting.fit_models
    monkeypatch.setattr(boosting, "fit_models", lambda *a, **k: calls.append(len(a[2])) or real(*a, **k))
    stages = [({"eta": ("uniform", 0.1, 0.5), "max_depth": ("quniform", 1, 3, 1)}, 4), ({"num_rounds": 4, "eta": ("uniform", 0.1, 0.3)}, 2)]
    best, table = rank_model.search_params(df, stages, {"num_rounds": 2, "min_child_weight": 0.1}, seed=1, num_folds=3)
    rows = table.collect()
    assert calls == [12, 6] and [(r.stage, r.candidate) for r in rows] == [(0, i) for i in range(4)] + [(1, i) for i in range(2)]
    assert best["num_rounds"] == 4
    one = rank_model.cross_validate(df, __import__("json").loads(rows[2].params), num_folds=3)
    assert -rank_model.cv_summary(one).first().loss_mean == pytest.approx(rows[2].score)
