"""Registered queries: ranker training / scoring / evaluation, cross-validation
and staged parameter search over ``training_rows``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import folds, rank_model
from ..operators.ranking_metrics import ndcg
from ..session import cut_lineage
from ..sources.tables import TRAIN_FEATURES
from .registry import register, rnd
from .training_queries import K_SHARES, NUM_FOLDS, ROUNDED_SQL, SEED, _rounded, _split_sql

PARAMS = {"eta": 0.3, "max_depth": 4, "min_child_weight": 1}


def _vectors(spark, sf_dir):
    # one row a page of a query, read by every count, fold and fit: the click log is read once
    return FT.assemble(cut_lineage(_rounded(spark, sf_dir)), TRAIN_FEATURES)


@register("ranker_scores")
def q_ranker_scores(spark, sf_dir):
    data = _vectors(spark, sf_dir)
    model = rank_model.fit_ranker(data, PARAMS)
    return rank_model.score(data, model).select("wikiid", "query", "hit_page_id", rnd("prediction", 6)
                                                .alias("prediction"))


@register("ranker_eval")
def q_ranker_eval(spark, sf_dir):
    data = _vectors(spark, sf_dir)
    model = rank_model.fit_ranker(data, PARAMS)
    trained = rank_model.evaluate(data, model).withColumnRenamed("ndcg", "ndcg_model")
    shown_order = _rounded(spark, sf_dir).withColumn("prediction", -F.col("f_position"))
    shown = rank_model.evaluate(shown_order, None).withColumnRenamed("ndcg", "ndcg_shown")
    return trained.join(shown, "wikiid")


CV_SQL = f"""
WITH RECURSIVE {ROUNDED_SQL},{_split_sql(K_SHARES, "fold")},
r AS (SELECT wikiid, query, label,
             row_number() OVER (PARTITION BY wikiid, query ORDER BY -f_ctr, label) AS rp,
             row_number() OVER (PARTITION BY wikiid, query ORDER BY label DESC) AS rl FROM rt),
qn AS (SELECT wikiid, query,
              sum(CASE WHEN rp <= 10 THEN (pow(2, label) - 1) / log2(rp + 1) ELSE 0 END) AS dcg,
              sum(CASE WHEN rl <= 10 THEN (pow(2, label) - 1) / log2(rl + 1) ELSE 0 END) AS idcg
       FROM r GROUP BY wikiid, query),
qf AS (SELECT qn.*, asg.fold, CASE WHEN idcg = 0 THEN 0.0 ELSE dcg / idcg END AS nd
       FROM qn JOIN asg USING (wikiid, query)),
f AS (SELECT CAST(range AS BIGINT) AS fold_id FROM range({NUM_FOLDS})),
per AS (SELECT f.fold_id, qf.wikiid, qf.fold = f.fold_id AS is_test, avg(nd) AS wn
        FROM qf, f GROUP BY f.fold_id, qf.wikiid, qf.fold = f.fold_id),
tri AS (SELECT fold_id, avg(CASE WHEN NOT is_test THEN wn END) AS train_ndcg,
               avg(CASE WHEN is_test THEN wn END) AS test_ndcg FROM per GROUP BY fold_id)
SELECT round(avg(-test_ndcg), 9) AS loss_mean, round(var_pop(-test_ndcg), 9) AS loss_var,
       round(avg(train_ndcg - test_ndcg), 9) AS gap_mean, round(var_pop(train_ndcg - test_ndcg), 9) AS gap_var
FROM tri
"""


@register("cv_summary", CV_SQL)
def q_cv_summary(spark, sf_dir):
    """A17 over a trials table: per fold, mean NDCG@10 of the ranking by
    click-through rate on the train and test queries of that fold."""
    rows = _rounded(spark, sf_dir)
    k = folds.group_k_fold(rows, NUM_FOLDS, "fold", ("query",), seed=SEED)
    scored = k.withColumn("prediction", F.col("f_ctr"))
    # all folds' train and test rows at once: a wiki of a fold's part is a cell of its own
    parts = folds.expand_folds(scored, "fold", NUM_FOLDS).withColumn("cell", F.to_json(F.struct("fold_id", "split", "wikiid")))
    per = ndcg(parts.withColumn("_pos", -F.col("prediction")), 10, position_col="_pos", wiki_col="cell", query_cols=("cell", "query"),
               tie_col="label")
    cell = F.from_json("cell", "fold_id int, split string")
    mean = per.groupBy(cell["fold_id"].alias("fold")).agg(
        F.avg(F.when(cell["split"] == "train", F.col("ndcg"))).alias("train_ndcg"), F.avg(F.when(cell["split"] == "test", F.col("ndcg"))).alias("test_ndcg"))
    table = mean.withColumn("loss", -F.col("test_ndcg"))
    s = rank_model.cv_summary(table)
    return s.select(*[rnd(c).alias(c) for c in ("loss_mean", "loss_var", "gap_mean", "gap_var")])


@register("ranker_cv")
def q_ranker_cv(spark, sf_dir):
    k = folds.group_k_fold(_vectors(spark, sf_dir), NUM_FOLDS, "fold", ("query",), seed=SEED)
    return rank_model.cross_validate(k, PARAMS)


@register("param_search")
def q_param_search(spark, sf_dir):
    data = _vectors(spark, sf_dir)
    k = folds.group_k_fold(data, NUM_FOLDS, "fold", ("query",), seed=SEED)
    n_obs = data.count()
    base, stages = rank_model.tune_stages(n_obs)
    _, table = rank_model.search_params(k, stages, base)
    return table
