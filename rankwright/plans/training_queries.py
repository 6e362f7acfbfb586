"""Registered queries: feature statistics, bins, mutual information, mRMR,
group splits, folds, layout runs and fold lines (over ``training_rows``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import folds, sampling, selection
from ..session import cut_lineage
from ..sources.tables import TRAIN_FEATURES, TRAINING_ROWS_SQL, training_rows
from .registry import register, rnd

N_BINS = 10
QUANTILE_BINS = 254
SHARES = (0.8, 0.2)
NUM_FOLDS = 3
SEED = 0


def _rounded(spark, sf_dir):
    tr = training_rows(spark, sf_dir)
    return tr.select("wikiid", "query", "hit_page_id", "label", *[rnd(f).alias(f) for f in TRAIN_FEATURES])


ROUNDED_SQL = f"""{TRAINING_ROWS_SQL},
rt AS (SELECT wikiid, query, hit_page_id, label, {", ".join(f"round({f}, 9) AS {f}" for f in TRAIN_FEATURES)}
       FROM tr)"""


def _stats_sql(fn: str) -> str:
    return " UNION ALL ".join(
        f"SELECT wikiid, '{f}' AS feature, {fn.format(f=f)} FROM rt GROUP BY wikiid" for f in TRAIN_FEATURES)


@register("feature_summary", f"""
WITH {ROUNDED_SQL}
{_stats_sql("count({f}) AS n, round(avg({f}), 9) AS mean, round(stddev_samp({f}), 9) AS stddev, "
            "min({f}) AS min_value, max({f}) AS max_value")}
""")
def q_feature_summary(spark, sf_dir):
    d = selection.describe_features(_rounded(spark, sf_dir), TRAIN_FEATURES)
    return d.select("wikiid", "feature", F.col("count").alias("n"), rnd("mean").alias("mean"),
                    rnd("stddev").alias("stddev"), F.col("min").alias("min_value"),
                    F.col("max").alias("max_value"))


@register("dataset_stats", f"""
WITH {ROUNDED_SQL}
SELECT wikiid, count(*) AS num_obs, count(DISTINCT query) AS num_queries FROM rt GROUP BY wikiid
""")
def q_dataset_stats(spark, sf_dir):
    return selection.dataset_summary(_rounded(spark, sf_dir))


def _binned(spark, sf_dir):
    """Bins of equal width, for comparison."""
    rows = cut_lineage(_rounded(spark, sf_dir))  # read for the splits and by every count
    splits = selection.equal_width_splits(rows, TRAIN_FEATURES, N_BINS)
    return selection.discretise(rows, splits)


def _quantile_edges(rows):
    """Exact edges of ``QUANTILE_BINS`` equal-count bins of every feature, +inf last."""
    long = rows.select(*TRAIN_FEATURES).unpivot([], list(TRAIN_FEATURES), "feature", "value")
    return sampling.exact_quantile_edges(long, "feature", "value", QUANTILE_BINS)


def _quantile_binned(spark, sf_dir):
    rows = cut_lineage(_rounded(spark, sf_dir))  # read for the edges and by every count
    splits = {r.feature: [float("-inf"), *r.edges] for r in _quantile_edges(rows).collect()}  # features x bins
    return selection.discretise(rows, splits)


def _edges_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS v FROM rt" for f in TRAIN_FEATURES)


EDGES_SQL = f"""{ROUNDED_SQL},
v AS ({_edges_sql()}),
r AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS i, count(*) OVER (PARTITION BY feature) AS c FROM v),
edge AS (SELECT DISTINCT feature, v AS edge FROM r JOIN range(1, {QUANTILE_BINS}) q(j) ON i = ceil(j * c / {QUANTILE_BINS}))"""

BINS_SQL = f"""{EDGES_SQL},
el AS (SELECT {", ".join(f"list(edge) FILTER (WHERE feature = '{f}') AS e_{f}" for f in TRAIN_FEATURES)} FROM edge),
bn AS (SELECT rt.wikiid, rt.query, rt.hit_page_id, rt.label,
              {", ".join(f"CAST(len(list_filter(e_{f}, lambda e: e <= {f})) AS DOUBLE) AS {f}_bin" for f in TRAIN_FEATURES)}
       FROM rt, el)"""


@register("feature_bins", f"""
WITH {BINS_SQL}
SELECT wikiid, query, hit_page_id, {", ".join(f + "_bin" for f in TRAIN_FEATURES)} FROM bn
""")
def q_feature_bins(spark, sf_dir):
    b = _quantile_binned(spark, sf_dir)
    return b.select("wikiid", "query", "hit_page_id", *[f + "_bin" for f in TRAIN_FEATURES])


def _mi_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT wikiid, '{f}' AS feature, {f}_bin AS v, CAST(label AS DOUBLE) AS y FROM bn" for f in TRAIN_FEATURES)
    return f"""
lg AS ({parts}),
c AS (SELECT wikiid, feature, v, y, count(*) AS n FROM lg GROUP BY ALL),
ca AS (SELECT wikiid, feature, v, sum(n) AS na FROM c GROUP BY ALL),
cb AS (SELECT wikiid, feature, y, sum(n) AS nb FROM c GROUP BY ALL),
ct AS (SELECT wikiid, feature, sum(n) AS nt FROM c GROUP BY ALL)"""


@register("feature_mi", f"""
WITH {BINS_SQL},{_mi_sql()}
SELECT c.wikiid, c.feature, round(sum((n / nt) * ln(n * nt / (na * nb))), 9) AS mi
FROM c JOIN ca USING (wikiid, feature, v) JOIN cb USING (wikiid, feature, y) JOIN ct USING (wikiid, feature)
GROUP BY c.wikiid, c.feature
""")
def q_feature_mi(spark, sf_dir):
    mi = selection.mutual_information(_quantile_binned(spark, sf_dir), TRAIN_FEATURES)
    return mi.select("wikiid", "feature", rnd("mi").alias("mi"))


@register("feature_quantiles", f"""
WITH {EDGES_SQL}
SELECT feature, edge FROM edge
""")
def q_feature_quantiles(spark, sf_dir):
    """Exact edges of 254 equal-count bins of every feature."""
    edges = _quantile_edges(_rounded(spark, sf_dir))
    return edges.select("feature", F.explode("edges").alias("edge")).where(F.col("edge") < float("inf"))


@register("mrmr")
def q_mrmr(spark, sf_dir):
    """Features by mRMR over the bins of ``feature_quantiles``."""
    return selection.select_features(_quantile_binned(spark, sf_dir), TRAIN_FEATURES, n=4)


def _split_sql(shares, out_col: str) -> str:
    """Greedy placement in SQL: one group a step of a recursion, heaviest first."""
    n = range(len(shares))
    lack = [f"{s!r} * CAST(o.tot AS DOUBLE) - r.p{j}" for j, s in zip(n, shares)]
    lack = [f"CASE WHEN must AND r.p{j} > 0 THEN -1e300 ELSE {x} END AS l{j}" for j, x in zip(n, lack)]
    best = "greatest(" + ", ".join(f"l{j}" for j in n) + ")"
    pick = "CASE " + " ".join(f"WHEN l{j} = {best} THEN {j}" for j in n) + " END"
    empty = " + ".join(f"CAST(r.p{j} = 0 AS INTEGER)" for j in n)
    return f"""
wt AS (SELECT wikiid, query, count(*) AS wt FROM rt GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY wikiid ORDER BY wt DESC, md5(concat_ws('/', '{SEED}', wikiid, query)), query) AS i,
             count(*) OVER (PARTITION BY wikiid) AS h, sum(wt) OVER (PARTITION BY wikiid) AS tot FROM wt),
greedy(wikiid, i, {", ".join(f"p{j}" for j in n)}, f) AS (
  SELECT DISTINCT wikiid, CAST(0 AS BIGINT), {", ".join("CAST(0 AS BIGINT)" for _ in n)}, CAST(-1 AS BIGINT) FROM o
  UNION ALL
  SELECT wikiid, i, {", ".join(f"CAST(p{j} + CASE WHEN f = {j} THEN wt ELSE 0 END AS BIGINT)" for j in n)}, CAST(f AS BIGINT)
  FROM (SELECT *, {pick} AS f FROM (
    SELECT o.wikiid, o.i, o.wt, {", ".join(f"r.p{j}" for j in n)}, o.h - o.i + 1 <= {empty} AS must, {", ".join(lack)}
    FROM greedy r JOIN o ON o.wikiid = r.wikiid AND o.i = r.i + 1))),
asg AS (SELECT o.wikiid, o.query, r.f AS {out_col} FROM o JOIN greedy r ON r.wikiid = o.wikiid AND r.i = o.i)"""


@register("group_split", f"""
WITH RECURSIVE {ROUNDED_SQL},{_split_sql(SHARES, "fold")}
SELECT rt.wikiid, rt.query, rt.hit_page_id, asg.fold FROM rt JOIN asg USING (wikiid, query)
""")
def q_group_split(spark, sf_dir):
    s = folds.split_groups(_rounded(spark, sf_dir), SHARES, "fold", ("query",), seed=SEED)
    return s.select("wikiid", "query", "hit_page_id", "fold")


K_SHARES = tuple([1.0 / NUM_FOLDS] * NUM_FOLDS)


@register("fold_expansion", f"""
WITH RECURSIVE {ROUNDED_SQL},{_split_sql(K_SHARES, "fold")}
SELECT rt.wikiid, rt.query, rt.hit_page_id, asg.fold, f.fold_id,
       CASE WHEN asg.fold = f.fold_id THEN 'test' ELSE 'train' END AS split
FROM rt JOIN asg USING (wikiid, query) JOIN (SELECT CAST(range AS BIGINT) AS fold_id FROM range({NUM_FOLDS})) f ON TRUE
""")
def q_fold_expansion(spark, sf_dir):
    k = folds.group_k_fold(_rounded(spark, sf_dir), NUM_FOLDS, "fold", ("query",), seed=SEED)
    return folds.expand_folds(k, "fold").select("wikiid", "query", "hit_page_id", "fold", "fold_id", "split")


@register("query_runs", f"""
WITH {ROUNDED_SQL}
SELECT wikiid, query, count(*) AS run_length FROM rt GROUP BY wikiid, query
""")
def q_query_runs(spark, sf_dir):
    rows = _rounded(spark, sf_dir).withColumn("qk", F.concat_ws("\u0001", "wikiid", "query"))
    laid = folds.ranking_layout(rows, 4, ("wikiid", "query"))
    runs = folds.query_runs(laid, "qk")
    parts = F.split("qk", "\u0001")
    return runs.select(parts[0].alias("wikiid"), parts[1].alias("query"), "run_length")


def _line_sql() -> str:
    items = ", ".join(
        f"CASE WHEN {f} <> 0 THEN '{i + 1}:' || printf('%.6f', {f}) END" for i, f in enumerate(TRAIN_FEATURES))
    return f"concat_ws(' ', CAST(label AS VARCHAR), {items})"


@register("fold_lines", f"""
WITH RECURSIVE {ROUNDED_SQL},{_split_sql(K_SHARES, "fold")}
SELECT f.fold_id, CASE WHEN asg.fold = f.fold_id THEN 'test' ELSE 'train' END AS split,
       rt.wikiid, rt.query, {_line_sql()} AS line
FROM rt JOIN asg USING (wikiid, query) JOIN (SELECT CAST(range AS BIGINT) AS fold_id FROM range({NUM_FOLDS})) f ON TRUE
""")
def q_fold_lines(spark, sf_dir):
    rows = FT.assemble(_rounded(spark, sf_dir), TRAIN_FEATURES)
    k = folds.group_k_fold(rows, NUM_FOLDS, "fold", ("query",), seed=SEED)
    return folds.fold_lines(k, "fold")
