"""Boosted ranking model (M12-M18, S15, A17): training, node tables, scoring, selection.

The objective is the lambda gradient of NDCG@10 and trees grow on gradient histograms
(``boosting``).  A model is a table of nodes (round, node, feature, threshold, left, right, value):
saved as Parquet, scored by one walk of all trees over a batch of rows.  Folds and
candidates of a search are models of one job.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .ranking_metrics import ndcg

GROUP = ("wikiid", "query")
NODES = ("round int, node int, feature int, threshold double, left int, right int, value double")

DEFAULT_PARAMS = {
    "num_rounds": 100, "eta": 0.3, "max_depth": 6, "min_child_weight": 1.0,
    "max_bin": 256, "subsample": 1.0, "colsample": 1.0, "seed": 0,
}
# Names used by the reference's trainer, mapped to ours.
ALIASES = {"colsample_bytree": "colsample"}
INT_PARAMS = ("num_rounds", "max_depth", "max_bin", "seed")


def coerce_params(params: dict) -> dict:
    """Defaults + integer coercion of integer-valued parameters."""
    p = dict(DEFAULT_PARAMS)
    p.update({ALIASES.get(k, k): v for k, v in (params or {}).items()})
    for k in INT_PARAMS:
        p[k] = int(p[k])
    return p


def _spec(params: dict, held_out: int = -1) -> boosting.Spec:
    p = coerce_params(params)
    return boosting.Spec(p["num_rounds"], float(p["eta"]), p["max_depth"], float(p["min_child_weight"]), float(p["subsample"]),
                         float(p["colsample"]), p["seed"], held_out)


@dataclass
class RankModel:
    """Nodes of all trees in round and node order (``NODES``); ``left`` is null at leaves, root is node 1."""
    nodes: list[tuple] = field(default_factory=list)
    features_col: str = "features"
    history: list = field(default_factory=list)  # (round, split, ndcg@10)

    @classmethod
    def of_trees(cls, trees: Sequence[boosting.Tree], edges: Sequence[np.ndarray], features_col: str = "features") -> "RankModel":
        nodes = []
        for rnd, tree in enumerate(trees):
            todo = [1]
            while todo:
                k = todo.pop(0)
                f = int(tree.feature[k])
                if f < 0:
                    nodes.append((rnd, k, None, None, None, None, float(tree.value[k])))
                else:
                    nodes.append((rnd, k, f, float(edges[f][tree.bin[k]]), 2 * k, 2 * k + 1, float(tree.value[k])))
                    todo += [2 * k, 2 * k + 1]
        return cls(sorted(nodes, key=lambda x: x[:2]), features_col)

    @property
    def trees(self) -> list[int]:
        """Rounds of the model."""
        return sorted({n[0] for n in self.nodes})

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODES)

    def save(self, path: str) -> None:
        """The node table as Parquet, plus a JSON manifest."""
        spark = SparkSession.getActiveSession()
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        manifest = json.dumps({"features_col": self.features_col, "history": self.history})
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")

    @classmethod
    def load(cls, path: str) -> "RankModel":
        spark = SparkSession.getActiveSession()
        manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
        nodes = [tuple(r) for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "node").collect()]
        return cls(nodes, manifest["features_col"], [tuple(h) for h in manifest["history"]])


def _trained(df: DataFrame, params: Sequence[dict], label_col: str, features_col: str, group: Sequence[str], fold_col: str | None,
             held_out: Sequence[int], every: int = 0) -> tuple[list[RankModel], DataFrame]:
    """Models of all ``params`` (one for each ``held_out`` fold) in one run, and their metric rows."""
    bins = max([coerce_params(p)["max_bin"] for p in params], default=2)
    edges = boosting.bin_edges(df, features_col, bins)
    blocks, n_blocks = boosting.layout(df, edges, label_col, features_col, group, fold_col)
    specs = [_spec(p, fold) for p, fold in zip(params, held_out)]
    trees, metrics = boosting.fit_models(blocks, n_blocks, specs, max([0, *map(len, edges)]) + 1, every)
    return [RankModel.of_trees(t, edges, features_col) for t in trees], metrics


def _means(metrics: DataFrame) -> DataFrame:
    """``model, round, test, ndcg``: mean over the wikis of their queries' mean NDCG@10."""
    per_wiki = metrics.groupBy("model", "round", "test", "wiki").agg((F.sum("ndcg_sum") / F.sum("n_queries")).alias("v"))
    return per_wiki.groupBy("model", "round", "test").agg(F.avg("v").alias("ndcg"))


def fit_ranker(df: DataFrame, params: dict | None = None, label_col: str = "label",
               features_col: str = "features", group: Sequence[str] = GROUP,
               eval_df: DataFrame | None = None, eval_every: int = 0) -> RankModel:
    """Train the boosted ranker; with ``eval_every`` the NDCG@10 history of training rows and ``eval_df``
    (whose rows are scored along with the training, not again for each round)."""
    if eval_df is None:
        rows, fold_col = df, None
    else:
        wanted = [*group, label_col, features_col]
        fold_col = "_split"
        rows = df.select(*wanted, F.lit(0).alias(fold_col)).unionByName(eval_df.select(*wanted, F.lit(1).alias(fold_col)))
    (model,), metrics = _trained(rows, [params or {}], label_col, features_col, group, fold_col, [1 if fold_col else -1], eval_every)
    if eval_every:
        model.history = [(r.round, "test" if r.test else "train", r.ndcg)
                         for r in _means(metrics).where(F.col("round") % eval_every == 0).orderBy("round", F.col("test")).collect()]
    return model


def score(df: DataFrame, model: RankModel, prediction_col: str = "prediction") -> DataFrame:
    """Add ``prediction``: the values of the leaves a row ends in, summed over the trees by one vectorised walk.
    A value beyond a threshold or missing (NaN) goes right; a null vector has no prediction."""
    spec = _walk_arrays(model.nodes)

    @F.pandas_udf("double")
    def predict(features: pd.Series) -> pd.Series:
        known = features.notna().to_numpy()
        out = np.full(len(features), np.nan)
        if known.any():
            out[known] = walk(np.stack(features[known].to_numpy()), *spec)
        return pd.Series(out).where(known, None)

    return df.withColumn(prediction_col, predict(vector_to_array(F.col(model.features_col))))


def _walk_arrays(nodes: Sequence[tuple]) -> tuple:
    """Roots of the trees, and feature, threshold, left, right, value by place (leaves point to themselves)."""
    place = {n[:2]: i for i, n in enumerate(nodes)}
    rounds = sorted({n[0] for n in nodes})
    child = [[i if n[4] is None else place[n[0], n[side]] for i, n in enumerate(nodes)] for side in (4, 5)]
    return (np.array([place[r, 1] for r in rounds], np.int64), np.array([n[2] or 0 for n in nodes], np.int64),
            np.array([0.0 if n[3] is None else n[3] for n in nodes]), *(np.array(c, np.int64) for c in child), np.array([n[6] for n in nodes]))


def walk(x: np.ndarray, roots, feature, threshold, left, right, value) -> np.ndarray:
    """Summed leaf values of each row of ``x``, tree by tree."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for root in roots.tolist():
        at = np.full(len(x), root)
        moving = rows if left[root] != root else rows[:0]
        while len(moving):
            now = at[moving]
            down = x[moving, feature[now]] <= threshold[now]
            now = np.where(down, left[now], right[now])
            at[moving] = now
            moving = moving[left[now] != now]
        total += value[at]
    return total


def evaluate(df: DataFrame, model: RankModel | None, label_col: str = "label", group: Sequence[str] = GROUP,
             k: int = 10, prediction_col: str = "prediction") -> DataFrame:
    """NDCG@k per wiki of the ranking by prediction desc; ties are broken
    pessimistically (lower label first)."""
    scored = score(df, model, prediction_col) if model is not None else df
    ranked = scored.withColumn("_pos", -F.col(prediction_col))
    return ndcg(ranked, k, label_col=label_col, position_col="_pos", query_cols=tuple(group), tie_col=label_col)


# ------------------------------------------------------------ model selection
TRIALS = "candidate int, fold int, train_ndcg double, test_ndcg double, loss double"


def cross_validate_many(folds: DataFrame, params: Sequence[dict], fold_col: str = "fold", num_folds: int | None = None,
                        label_col: str = "label", features_col: str = "features", group: Sequence[str] = GROUP) -> DataFrame:
    """M16 for many candidates: every candidate trained on every fold's complement, all models advancing together.
    ``TRIALS`` rows (loss = -test NDCG@10 at the last round)."""
    if num_folds is None:
        num_folds = int(folds.schema[fold_col].metadata.get("num_folds") or folds.agg(F.max(fold_col)).first()[0] + 1)
    todo = [(c, k) for c in range(len(params)) for k in range(num_folds)]
    _, metrics = _trained(folds, [params[c] for c, _ in todo], label_col, features_col, group, fold_col, [k for _, k in todo])
    means = _means(metrics).groupBy("model").agg(F.max(F.when(~F.col("test"), F.col("ndcg"))).alias("train_ndcg"),
                                                 F.max(F.when(F.col("test"), F.col("ndcg"))).alias("test_ndcg"))
    trials = means.select(F.floor(F.col("model") / num_folds).cast("int").alias("candidate"), (F.col("model") % num_folds).cast("int").alias("fold"),
                          "train_ndcg", "test_ndcg", (-F.col("test_ndcg")).alias("loss"))
    if trials.where("train_ndcg is null or test_ndcg is null").take(1) or trials.count() < len(todo):
        raise ValueError("no rows to evaluate: a fold is empty")
    return trials


def cross_validate(folds: DataFrame, params: dict, fold_col: str = "fold", num_folds: int | None = None,
                   label_col: str = "label", group: Sequence[str] = GROUP) -> DataFrame:
    """Train on every fold's complement, evaluate on the fold; returns a
    trials table (fold, train_ndcg, test_ndcg, loss = -test_ndcg)."""
    return cross_validate_many(folds, [params], fold_col, num_folds, label_col, group=group).drop("candidate")


def cv_summary(trials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population variance of the loss and of the train−test gap."""
    gap = F.col("train_ndcg") - F.col("test_ndcg")
    aggs = [F.avg("loss").alias("loss_mean"), F.var_pop("loss").alias("loss_var"),
            F.avg(gap).alias("gap_mean"), F.var_pop(gap).alias("gap_var")]
    return trials.groupBy(*by).agg(*aggs) if by else trials.agg(*aggs)


# Observation-count profiles (strictly greater than), their
# initial search spaces, the per-profile baseline, and the final trees stage.
PROFILES = [("xlarge", 8_000_000), ("large", 1_000_000), ("med", 500_000), ("small", 500), ("xsmall", 0)]
SPACES = {
    "xlarge": {"eta": ("uniform", 0.3, 0.8), "max_depth": ("quniform", 6, 11, 1),
               "min_child_weight": ("qloguniform", 10, 500, 10),
               "colsample": ("quniform", 0.8, 1, 0.01), "subsample": ("quniform", 0.8, 1, 0.01)},
    "large": {"eta": ("uniform", 0.3, 0.6), "max_depth": ("quniform", 5, 9, 1),
              "min_child_weight": ("qloguniform", 10, 300, 10),
              "colsample": ("quniform", 0.8, 1, 0.01), "subsample": ("quniform", 0.8, 1, 0.01)},
    "med": {"eta": ("uniform", 0.1, 0.6), "max_depth": ("quniform", 4, 7, 1),
            "min_child_weight": ("qloguniform", 10, 300, 10),
            "colsample": ("quniform", 0.8, 1, 0.01), "subsample": ("quniform", 0.8, 1, 0.01)},
    "small": {"eta": ("uniform", 0.1, 0.4), "max_depth": ("quniform", 3, 6, 1),
              "min_child_weight": ("qloguniform", 10, 100, 10),
              "colsample": ("quniform", 0.8, 1, 0.01), "subsample": ("quniform", 0.8, 1, 0.01)},
    "xsmall": {"eta": ("uniform", 0.1, 0.4), "max_depth": ("quniform", 3, 6, 1),
               "min_child_weight": 0,
               "colsample": ("quniform", 0.8, 1, 0.01), "subsample": ("quniform", 0.8, 1, 0.01)},
}
BASE_DEPTH = {"xlarge": 7, "large": 6, "med": 5, "small": 4, "xsmall": 3}
BASE_PARAMS = {"num_rounds": 100, "min_child_weight": 200, "subsample": 1.0, "colsample": 0.8}
FINAL_STAGE = {"eta": ("uniform", 0.1, 0.4)}
INITIAL_ITERATIONS, FINAL_ITERATIONS = 150, 30


def tune_stages(num_obs: int, initial_trees: int = 100, final_trees: int | None = 500,
                initial_iterations: int = INITIAL_ITERATIONS) -> tuple[dict, list]:
    """(baseline params, stages) for a dataset size."""
    prof = size_profile(num_obs)
    base = {**BASE_PARAMS, "num_rounds": initial_trees, "max_depth": BASE_DEPTH[prof]}
    stages = [(SPACES[prof], initial_iterations)]
    if final_trees is not None and final_trees != initial_trees:
        stages.append(({"num_rounds": final_trees, **FINAL_STAGE}, FINAL_ITERATIONS))
    return base, stages


def size_profile(num_obs: int) -> str:
    """Profile name for a dataset size (strictly greater than the bound)."""
    for name, lower in PROFILES:
        if num_obs > lower:
            return name
    return "xsmall"


def _draw(spec, rng: random.Random) -> float:
    kind = spec[0]
    if kind == "uniform":
        return rng.uniform(spec[1], spec[2])
    if kind == "quniform":
        return round(rng.uniform(spec[1], spec[2]) / spec[3]) * spec[3]
    if kind == "qloguniform":
        return round(math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2]))) / spec[3]) * spec[3]
    if kind == "choice":
        return rng.choice(spec[1])
    raise ValueError(kind)


def candidates(space: dict, n: int, seed: int = 0) -> list[dict]:
    """Random candidates from a space; fixed values pass through."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append({k: (_draw(v, rng) if isinstance(v, tuple) else v) for k, v in space.items()})
    return out


def search_params(folds: DataFrame, stages: Sequence[tuple[dict, int]], base: dict | None = None,
                  seed: int = 0, **cv_kwargs) -> tuple[dict, DataFrame]:
    """Staged selection.  Each stage's space overrides the best params
    found so far; the stage's best (max -loss, ties: the first) is carried forward.  A stage's
    candidates and folds are trained together.  Returns (best params, trials table with stage, candidate,
    params JSON, -loss and -loss + gap)."""
    spark = folds.sparkSession
    best = dict(base or {})
    rows = []
    for si, (space, n) in enumerate(stages):
        drawn = [{**best, **cand} for cand in candidates(space, n, seed + si)]
        if not drawn:
            continue
        trials = cross_validate_many(folds, drawn, **cv_kwargs)
        found = sorted(cv_summary(trials, ("candidate",)).collect(), key=lambda r: r.candidate)  # one row a candidate
        rows += [(si, r.candidate, json.dumps(drawn[r.candidate], sort_keys=True), -r.loss_mean, -r.loss_mean + r.gap_mean) for r in found]
        best = drawn[min(found, key=lambda r: (r.loss_mean, r.candidate)).candidate]
    table = spark.createDataFrame(rows, "stage int, candidate int, params string, score double, "
                                        "score_with_gap double")
    return best, table
