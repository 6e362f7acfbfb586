"""Feature statistics, discretisation, mutual information and mRMR.

All statistics run on the unpivoted (key, feature, value) form so one job
covers every feature and every wiki; only split edges (features × buckets)
and per-step winners (one row per wiki) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _long(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return df.unpivot(list(keep), list(names), "feature", "value")


def describe_features(df: DataFrame, names: Sequence[str], by: str = "wikiid") -> DataFrame:
    """A10: count / mean / stddev (sample) / min / max per (by, feature)."""
    long = _long(df.select(by, *names), names, [by])
    return long.groupBy(by, "feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"), F.min("value").alias("min"), F.max("value").alias("max"))


def dataset_summary(df: DataFrame, by: str = "wikiid", query_col: str = "query",
                    group_col: str | None = None) -> DataFrame:
    """Observations, distinct queries (and groups) per wiki."""
    aggs = [F.count(F.lit(1)).alias("num_obs"), F.count_distinct(query_col).alias("num_queries")]
    if group_col:
        aggs.append(F.count_distinct(group_col).alias("num_norm_queries"))
    return df.groupBy(by).agg(*aggs)


def wikis_by_size(df: DataFrame, by: str = "wikiid") -> DataFrame:
    """O3: wikis by descending number of observations (ties by name)."""
    return (df.groupBy(by).agg(F.count(F.lit(1)).alias("num_obs"))
            .orderBy(F.col("num_obs").desc(), F.col(by).asc()))


def quantile_splits(df: DataFrame, names: Sequence[str], num_buckets: int = 254) -> DataFrame:
    """Approximate quantile split points per feature (relative error
    1/(10·N)), padded with -inf/+inf; one grouped ``percentile_approx`` job."""
    probs = [k / num_buckets for k in range(1, num_buckets)]
    long = _long(df.select(*names), names, [])
    pct = F.percentile_approx("value", probs, 10 * num_buckets)
    return long.groupBy("feature").agg(
        F.concat(F.array(F.lit(float("-inf"))), F.array_sort(F.array_distinct(pct)),
                 F.array(F.lit(float("inf")))).alias("splits"))


def equal_width_splits(df: DataFrame, names: Sequence[str], num_buckets: int) -> dict[str, list[float]]:
    """Equal-width split points between each feature's min and max."""
    row = df.agg(*[F.min(n).alias(f"mn_{i}") for i, n in enumerate(names)],
                 *[F.max(n).alias(f"mx_{i}") for i, n in enumerate(names)]).collect()[0]
    out = {}
    for i, n in enumerate(names):
        lo, hi = float(row[f"mn_{i}"]), float(row[f"mx_{i}"])
        width = (hi - lo) / num_buckets
        inner = sorted({lo + k * width for k in range(1, num_buckets)}) if width > 0 else []
        out[n] = [float("-inf"), *inner, float("inf")]
    return out


def discretise(df: DataFrame, splits: dict[str, Sequence[float]], suffix: str = "_bin") -> DataFrame:
    """M9: bucket every feature by its split points (shared split matrix);
    ``Bucketizer`` multi-column, invalid values raise."""
    names = list(splits)
    b = Bucketizer(splitsArray=[list(splits[n]) for n in names], inputCols=names,
                   outputCols=[n + suffix for n in names], handleInvalid="error")
    return b.transform(df)


def splits_from_table(table: DataFrame) -> dict[str, list[float]]:
    """Collect a (feature, splits) table: bounded by features × buckets."""
    return {r.feature: list(r.splits) for r in table.collect()}


def _entropy_terms(counts: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """I(a; b) per key from joint counts n(key, a, b)."""
    k = list(keys)
    na = counts.groupBy(*k, a).agg(F.sum("n").alias("na"))
    nb = counts.groupBy(*k, b).agg(F.sum("n").alias("nb"))
    tot = counts.groupBy(*k).agg(F.sum("n").alias("nt"))
    j = counts.join(na, [*k, a]).join(nb, [*k, b]).join(tot, k)
    term = (F.col("n") / F.col("nt")) * F.log(F.col("n") * F.col("nt") / (F.col("na") * F.col("nb")))
    return j.groupBy(*k).agg(F.sum(term).alias("mi"))


def mutual_information(binned: DataFrame, names: Sequence[str], label_col: str = "label",
                       by: str = "wikiid", suffix: str = "_bin") -> DataFrame:
    """M10 (relevance part): I(feature bin; label) per (by, feature), natural log."""
    long = binned.select(by, F.col(label_col).cast("double").alias("_y"),
                         *[F.col(n + suffix).alias(n) for n in names])
    long = _long(long, names, [by, "_y"])
    counts = long.groupBy(by, "feature", "value", "_y").agg(F.count(F.lit(1)).alias("n"))
    return _entropy_terms(counts, [by, "feature"], "value", "_y")


def select_features(binned: DataFrame, names: Sequence[str], n: int = 50, label_col: str = "label",
                    by: str = "wikiid", suffix: str = "_bin",
                    preselected: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """mRMR (Peng et al. 2005, difference form) per ``by`` value.

    Step 1 takes the feature with the largest I(f; label); each next step adds
    argmax_f I(f; label) − mean_{s∈S} I(f; s).  One grouped count job per step
    computes I(f; last selected) for every remaining feature of every wiki.
    ``n`` ≥ number of features returns all as they stand; a wiki with ``preselected``
    features gets exactly those.  Returns (by, rank, feature).
    """
    names = list(names)
    spark = binned.sparkSession
    given = preselected or {}
    if n >= len(names) or given:
        wikis = sorted(r[0] for r in binned.select(by).distinct().collect())  # one row per wiki
        as_is = {w: list(given[w]) if w in given else names for w in wikis if w in given or n >= len(names)}
        fixed = [(w, i + 1, f) for w in as_is for i, f in enumerate(as_is[w])]
        done = spark.createDataFrame(fixed, f"{by} string, rank int, feature string")
        rest = [w for w in wikis if w not in as_is]
        if not rest:
            return done
        return done.unionByName(select_features(binned.where(F.col(by).isin(rest)), names, n, label_col, by, suffix))
    binned = cut_lineage(binned)  # read once a step
    rel = mutual_information(binned, names, label_col, by, suffix).withColumnRenamed("mi", "relevance")
    rel = rel.cache()
    wikis = [r[0] for r in rel.select(by).distinct().collect()]  # one row per wiki
    chosen: dict[str, list[str]] = {w: [] for w in wikis}
    redundancy = {w: {f: 0.0 for f in names} for w in wikis}
    k = min(n, len(names))
    rel_rows = {(r[by], r.feature): r.relevance for r in rel.collect()}  # wikis × features
    pending: dict[str, list[str]] = {w: [] for w in wikis}
    while any(len(chosen[w]) < k for w in wikis) or any(pending.values()):
        new_last = {}
        for w in wikis:
            for s in pending[w]:
                new_last.setdefault(w, []).append(s)
        pending = {w: [] for w in wikis}
        if new_last:
            _add_redundancy(binned, names, by, suffix, new_last, redundancy, spark)
        progressed = False
        for w in wikis:
            if len(chosen[w]) >= k:
                continue
            rest = [f for f in names if f not in chosen[w]]
            if not rest:
                continue
            m = max(len(chosen[w]), 1)
            score = {f: rel_rows.get((w, f), 0.0) - (redundancy[w][f] / m if chosen[w] else 0.0) for f in rest}
            best = max(rest, key=lambda f: (score[f], -names.index(f)))
            chosen[w].append(best)
            pending[w] = [best]
            progressed = True
        if not progressed:
            break
        if all(len(chosen[w]) >= k for w in wikis):
            break
    rel.unpersist()
    rows = [(w, i + 1, f) for w in wikis for i, f in enumerate(chosen[w][:k])]
    return spark.createDataFrame(rows, f"{by} string, rank int, feature string")


def _add_redundancy(binned, names, by, suffix, last: dict[str, list[str]], redundancy, spark):
    """Add I(f; s) for every feature f and each newly selected s, per wiki.

    The newly selected feature differs per wiki, so one column expression
    picks, row by row, the bin of that wiki's selection; a single grouped count
    over the unpivoted features then gives every I(f; s)."""
    depth = max(len(v) for v in last.values())
    for i in range(depth):
        picks = {w: ss[i] for w, ss in last.items() if len(ss) > i}
        sv = None
        for w, f in picks.items():
            cond = F.col(by) == w
            sv = F.when(cond, F.col(f + suffix)) if sv is None else sv.when(cond, F.col(f + suffix))
        rows = (binned.where(F.col(by).isin(list(picks)))
                .select(by, sv.alias("_sv"), *[F.col(n + suffix).alias(n) for n in names]))
        joint = (_long(rows, names, [by, "_sv"])
                 .groupBy(by, "feature", "value", "_sv").agg(F.count(F.lit(1)).alias("n")))
        mi = _entropy_terms(joint, [by, "feature"], "value", "_sv")
        for r in mi.collect():  # wikis × features
            redundancy[r[by]][r.feature] += r.mi
