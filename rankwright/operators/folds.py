"""Group-preserving splits, k-fold, fold expansion, ranking layout and fold files
(M6-M8, O1, W4, A18, S8, S9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from ..functions.columns import with_column_metadata
from ..session import cut_lineage

# The heaviest groups of a wiki that are placed one by one; the others (each at most a
# thousandth of the wiki) go by a distributed prefix sum in md5 order, in buckets of the
# first hex digits.
HEAVY_GROUPS = 1000
COARSE_DIGITS = 3


def place_by_deficit(weights: Sequence[int], total: int, shares: Sequence[float]) -> list[int]:
    """Split of each group, in the given order: the split that lacks most of its share, but one
    without a group as long as the groups left are no more than such splits (ties: the first)."""
    placed, out = [0] * len(shares), []
    for i, w in enumerate(weights):
        empty = [j for j, p in enumerate(placed) if not p]
        choice = empty if len(weights) - i <= len(empty) else range(len(shares))
        best = max(choice, key=lambda j: (shares[j] * total - placed[j], -j))
        placed[best] += w
        out.append(best)
    return out


def _place_light(light: DataFrame, lacking: DataFrame, wiki_col: str, g: list[str], splits: int) -> DataFrame:
    """Light groups by their running weight in md5 order, against what each split still lacks."""
    keyed = light.withColumn("_b", F.substring("_k", 1, COARSE_DIGITS))
    totals = keyed.groupBy(wiki_col, "_b").agg(F.sum("_w").alias("_bw"))
    before = Window.partitionBy(wiki_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.withColumn("_off", F.coalesce(F.sum("_bw").over(before), F.lit(0)))
               .withColumn("_light", F.sum("_bw").over(Window.partitionBy(wiki_col))))
    inside = Window.partitionBy(wiki_col, "_b").orderBy("_k", *g).rowsBetween(Window.unboundedPreceding, -1)
    start = (F.col("_off") + F.coalesce(F.sum("_w").over(inside), F.lit(0))) / F.col("_light")
    rows = keyed.join(offsets, [wiki_col, "_b"]).withColumn("_start", start).join(lacking, wiki_col)
    split = F.lit(splits - 1)
    for j in reversed(range(splits - 1)):
        split = F.when(F.col("_start") < F.col("_bounds")[j], F.lit(j)).otherwise(split)
    return rows.select(wiki_col, *g, split.cast("bigint").alias("_split"))


def split_groups(df: DataFrame, shares: Sequence[float], output_col: str = "fold",
                 group_cols: Sequence[str] = ("norm_query_id",), wiki_col: str = "wikiid",
                 seed: int = 0) -> DataFrame:
    """M6: assign whole groups to splits so each wiki's *rows* are divided by
    ``shares`` (which must sum to 1 ± 0.01).

    Groups are weighted by their row count.  The ``HEAVY_GROUPS`` heaviest of a wiki (ties
    in the order of an md5 of seed, wiki, group) go one by one to the split that lacks most;
    the rest are laid out in md5 order and cut where their running weight fills what the
    splits still lack.  No split stays empty while there are as many groups as splits.  A
    task holds at most ``HEAVY_GROUPS`` weights of a wiki.
    """
    if abs(1 - sum(shares)) >= 0.01:
        raise ValueError("shares must sum to 1")
    g, shares = list(group_cols), [float(s) for s in shares]
    keyed = F.lit(True)
    for c in (wiki_col, *g):
        keyed = keyed & F.col(c).isNotNull()
    # rows without a wiki or group stay: their group goes to a split drawn by a hash of what they have
    keyless, df = df.where(~keyed), df.where(keyed)
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.to_json(F.array(*[F.col(c).cast("string") for c in (wiki_col, *g)]))), F.lit(1 << 20)) / float(1 << 20)
    by_hash = F.lit(len(shares) - 1)
    for j in reversed(range(len(shares) - 1)):
        by_hash = F.when(drawn < sum(shares[:j + 1]), F.lit(j)).otherwise(by_hash)
    key = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col(wiki_col).cast("string"),
                            *[F.col(c).cast("string") for c in g]))
    weights = cut_lineage(df.groupBy(wiki_col, *g).agg(F.count(F.lit(1)).alias("_w")).withColumn("_k", key))
    by_weight = Window.partitionBy(wiki_col).orderBy(F.col("_w").desc(), "_k", *g)
    heavy = weights.withColumn("_i", F.row_number().over(by_weight)).where(F.col("_i") <= HEAVY_GROUPS)
    totals = weights.groupBy(wiki_col).agg(F.sum("_w").alias("_total"))
    heavy = heavy.join(totals, wiki_col).select(wiki_col, *g, "_w", "_i", "_total")
    schema = heavy.select(wiki_col, *g, "_w", "_total").schema.add("_split", LongType())

    def place(pdf):
        pdf = pdf.sort_values("_i")
        return pdf.assign(_split=place_by_deficit(pdf["_w"].tolist(), int(pdf["_total"].iloc[0]), shares))[schema.names]

    placed = cut_lineage(heavy.groupBy(wiki_col).applyInPandas(place, schema))
    got = [F.sum(F.when(F.col("_split") == j, F.col("_w")).otherwise(0)) for j in range(len(shares))]
    lacks = [F.greatest(F.lit(s) * F.first("_total") - n, F.lit(0.0)) for s, n in zip(shares, got)]
    lacking = placed.groupBy(wiki_col).agg(F.array(*lacks).alias("_lack"))
    whole = F.aggregate("_lack", F.lit(0.0), lambda a, x: a + x)
    lacking = lacking.select(wiki_col, F.transform(
        F.sequence(F.lit(1), F.lit(len(shares))),
        lambda n: F.try_divide(F.aggregate(F.slice("_lack", F.lit(1), n), F.lit(0.0), lambda a, x: a + x), whole)).alias("_bounds"))
    light = weights.join(placed.select(wiki_col, *g), [wiki_col, *g], "left_anti")
    assignment = placed.select(wiki_col, *g, "_split").unionByName(
        _place_light(light, lacking, wiki_col, g, len(shares))).withColumnRenamed("_split", output_col)
    return df.join(assignment, [wiki_col, *g]).unionByName(keyless.withColumn(output_col, by_hash.cast("bigint")))


def group_k_fold(df: DataFrame, num_folds: int, output_col: str = "fold",
                 group_cols: Sequence[str] = ("norm_query_id",), wiki_col: str = "wikiid",
                 seed: int = 0) -> DataFrame:
    """M7: equal-share group split into ``num_folds`` folds; the fold column
    carries ``num_folds`` metadata."""
    out = split_groups(df, [1.0 / num_folds] * num_folds, output_col, group_cols, wiki_col, seed)
    return with_column_metadata(out, output_col, {"num_folds": num_folds})


def expand_folds(df: DataFrame, fold_col: str | None = "fold", num_folds: int | None = None) -> DataFrame:
    """M8: one copy of each row per fold: ``split`` = test in its own fold,
    train in the others.  Without a fold column every row is ``all`` in
    fold 0.  Expansion is an ``explode`` of the fold ids (no join)."""
    if fold_col is None or fold_col not in df.columns:
        # a generated row, not literals: the writer's required order ignores constant columns
        only = F.array(F.struct(F.lit(0).cast("bigint").alias("fold_id"), F.lit("all").alias("split")))
        return df.select("*", F.inline(only))
    if num_folds is None:
        num_folds = int(df.schema[fold_col].metadata["num_folds"])
    ids = F.sequence(F.lit(0).cast("bigint"), F.lit(num_folds - 1).cast("bigint"))
    return (df.withColumn("fold_id", F.explode(ids))
            .withColumn("split", F.when(F.col(fold_col) == F.col("fold_id"), "test").otherwise("train")))


def ranking_layout(df: DataFrame, num_partitions: int, keys: Sequence[str] = ("wikiid", "query"),
                   label_col: str = "label") -> DataFrame:
    """O1: every query's rows in one partition, contiguous, sorted by label."""
    return df.repartition(num_partitions, *keys).sortWithinPartitions(*keys, label_col)


def query_runs(df: DataFrame, query_col: str = "query") -> DataFrame:
    """Run lengths of consecutive equal queries within each partition,
    in input order: (partition, run, query, run_length).  Gaps-and-islands with
    ``lag`` over (partition id, position), one window per input partition."""
    tagged = (df.select(query_col)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    w = Window.partitionBy("_pid").orderBy("_pos")
    starts = tagged.withColumn(
        "_new", F.when(F.lag(query_col).over(w).eqNullSafe(F.col(query_col)), 0).otherwise(1))
    runs = starts.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (runs.groupBy("_pid", "run").agg(F.first(query_col).alias(query_col),
                                            F.count(F.lit(1)).alias("run_length"),
                                            F.min("_pos").alias("_first"))
            .withColumnRenamed("_pid", "partition"))


def feature_line(label_col: str = "label", features_col: str = "features", digits: int = 6):
    """S8 line: ``label 1:f1 2:f2 …`` (1-based indices, zero values omitted)."""
    arr = vector_to_array(F.col(features_col))
    idx = F.sequence(F.lit(1), F.size(arr))
    pairs = F.filter(F.arrays_zip(idx.alias("i"), arr.alias("v")), lambda p: p["v"] != 0)
    items = F.transform(pairs, lambda p: F.concat(p["i"].cast("string"), F.lit(":"),
                                                  F.format_string(f"%.{digits}f", p["v"])))
    return F.array_join(F.concat(F.array(F.col(label_col).cast("int").cast("string")), items), " ")


def fold_lines(df: DataFrame, fold_col: str | None = "fold", num_folds: int | None = None,
               label_col: str = "label", features_col: str = "features") -> DataFrame:
    """(fold_id, split, query, line) for every fold × split."""
    expanded = expand_folds(df, fold_col, num_folds)
    return expanded.select("fold_id", "split", "wikiid", "query",
                           feature_line(label_col, features_col).alias("line"))


def write_folds(df: DataFrame, path: str, num_workers: int = 1, fold_col: str | None = "fold",
                num_folds: int | None = None, label_col: str = "label",
                features_col: str = "features") -> None:
    """Text fold files per wiki, fold, split (``train``, ``test``, or ``all`` without
    folds) and worker, as ``data/wikiid=…/fold_id=…/split=…/worker=…``: whole queries, each
    sorted by label; beside them ``query/…`` has the run length of each query in the same
    order.  Every set of a worker is one file, written by one task."""
    sets = ["wikiid", "fold_id", "split", "worker"]
    # a partition column that can be null would be rewritten by the writer, which then sorts anew
    rows = expand_folds(df, fold_col, num_folds).select(
        F.coalesce("wikiid", F.lit("")).alias("wikiid"), "fold_id", "split", F.pmod(F.xxhash64("wikiid", "query"), F.lit(num_workers)).alias("worker"),
        "query", F.col(label_col).alias("_label"), feature_line(label_col, features_col).alias("line"))
    rows = rows.repartition(*sets).sortWithinPartitions(*sets, "query", "_label", "line")
    rows.select(*sets, "line").write.mode("overwrite").partitionBy(*sets).text(f"{path}/data")
    sizes = rows.groupBy(*sets, "query").agg(F.count(F.lit(1)).cast("string").alias("value"))
    sizes.repartition(*sets).sortWithinPartitions(*sets, "query").select(*sets, "value") \
        .write.mode("overwrite").partitionBy(*sets).text(f"{path}/query")
