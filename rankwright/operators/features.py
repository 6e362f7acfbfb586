"""Feature collection and feature-vector operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_column_metadata
from ..functions.expressions import Feature, derived, minimal_feature_set, used_features
from . import field_index as X
from . import retrieval as R

KEYS = ("lang", "item_id", "doc_id")


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Ordered feature names stored in the vector column's metadata."""
    return list(df.schema[col].metadata.get("features", []))


def _compute(feature: Feature, queries, docs, cand, values) -> DataFrame:
    """One feature as (lang, item_id, doc_id, <name>) over the candidate rows."""
    k = list(KEYS)
    if feature.kind == "match":
        m = R.match_score(queries, docs, feature.field, pairs=cand)
        return m.select(*k, F.col("score").alias(feature.name))
    if feature.kind == "explorer":
        ex = R.explore_terms(queries, docs, cand, feature.field, aggs=[feature.params["agg"]],
                             stats=[feature.params["stat"]])
        col = f"{feature.params['agg']}_{feature.params['stat']}"
        return cand.select(*k).join(ex.select("lang", "item_id", F.col(col).alias(feature.name)),
                                    ["lang", "item_id"])
    if feature.kind == "phrase":
        return R.phrase_match(queries, docs, pairs=cand).select(*k, F.col("phrase_freq").cast("double").alias(feature.name))
    if feature.kind == "token_router":
        ph = R.phrase_match(queries, docs, pairs=cand)
        n_tok = queries.select("item_id", F.size(R.analyze("text", "plain")).alias("_n"))
        return (cand.select(*k).join(n_tok, "item_id").join(ph, k, "left")
                .select(*k, R.token_router("_n", "phrase_freq", feature.params.get("limit", 10))
                        .alias(feature.name)))
    if feature.kind == "terms_count":
        ut = R.unique_terms(queries)
        col = "unique_terms" if feature.field == "text" else "unique_terms_plain"
        return cand.select(*k).join(ut.select("item_id", F.col(col).cast("double").alias(feature.name)),
                                    "item_id")
    if feature.kind == "field_value":
        fv = R.field_value(docs, values, feature.field, feature.name)
        return cand.select(*k).join(fv, "doc_id")
    raise ValueError(feature.kind)


def collect_features(candidates: DataFrame, queries: DataFrame, docs: DataFrame,
                     features: Sequence[Feature], values: DataFrame | None = None,
                     wanted: Sequence[str] | None = None, missing: str = "zero") -> DataFrame:
    """One row per candidate (lang, item_id, doc_id) with every
    feature as a column (fixed order) and as a ``features`` vector whose
    metadata lists the names.

    Only the requested features and their dependencies are computed (R16).
    ``missing='zero'`` fills absent values with 0; ``'nan'`` marks them NaN so
    failed rows can be dropped (R15).  Every feature is a left join on the
    candidate key, so Catalyst prunes what is not selected.
    """
    if wanted is not None:
        features = minimal_feature_set(features, wanted)
    k = list(KEYS)
    # Every feature joins the candidate keys: materialise them once.
    cand = candidates.select(*k).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    out = cand
    # Explorer features of one field share one statistics pass.
    explorers: dict[str, list[Feature]] = {}
    for f in features:
        if f.kind == "explorer":
            explorers.setdefault(f.field, []).append(f)
    for fld, group in explorers.items():
        stats = sorted({f.params["stat"] for f in group})
        aggs = sorted({f.params["agg"] for f in group})
        ex = R.explore_terms(queries, docs, cand, fld, stats=stats, aggs=aggs)
        cols = [F.col(f"{f.params['agg']}_{f.params['stat']}").alias(f.name) for f in group]
        out = out.join(ex.select("lang", "item_id", *cols), ["lang", "item_id"], "left")
    for f in features:
        if f.kind in ("derived", "explorer"):
            continue
        out = out.join(_compute(f, queries, docs, cand, values), k, "left")
    fill = F.lit(0.0) if missing == "zero" else F.lit(float("nan"))
    for f in features:
        if f.kind == "derived":
            out = out.withColumn(f.name, derived(f.params["expression"]).cast("double"))
        else:
            out = out.withColumn(f.name, F.coalesce(F.col(f.name).cast("double"), fill))
    names = [f.name for f in features]
    out = out.withColumn("features", array_to_vector(F.array(*[F.col(n) for n in names])))
    return with_column_metadata(out, "features", {"features": names})


# Status of a collected value.
VALUE, NO_MATCH, FAILED, ABSENT = 0, 1, 2, 3


def collect_field_features(candidates: DataFrame, queries: DataFrame, index: X.FieldIndex, features: Sequence[Feature],
                           values: DataFrame | None = None, tables: dict[str, DataFrame] | None = None,
                           wanted: Sequence[str] | None = None) -> DataFrame:
    """R14-R16 over a field index: one row a candidate (lang, item_id, doc_id) with every feature as a column, ``features``
    (vector with the names in its metadata) and ``status`` (one code a feature).

    * A feature that finds nothing is 0 (``NO_MATCH``).
    * A feature of a document marked ``unreadable`` in ``values``, or a value that is no number, is NaN (``FAILED``), as is
      what is derived from it.
    * An external feature (a column of ``tables[name]``, joined on its ``on`` columns) without a row is NaN (``ABSENT``).

    All match features and phrases come from one pass over the candidates' texts, all term statistics from one over their
    queries; only requested features and what they use are computed."""
    if wanted is not None:
        features = minimal_feature_set(features, wanted)
    asked = [f.params["feature"] if f.kind == "token_router" else f for f in features]
    k = list(KEYS)
    cand = candidates.select(*k).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    index._cached.append(cand)
    out = cand
    matches = sorted({f.field for f in asked if f.kind == "match"})
    phrases = sorted({f.field for f in asked if f.kind == "phrase"})
    explored = [f for f in asked if f.kind == "explorer"]
    if matches or phrases:
        found = X.pair_values(queries, index, matches, phrases, cand)
        out = out.join(found.select(*k, *[F.get("score", F.lit(i)).alias(f"match:{m}") for i, m in enumerate(matches)],
                                    *[F.get("phrase", F.lit(i)).cast("double").alias(f"phrase:{p}") for i, p in enumerate(phrases)]), k, "left")
    counted = sorted({f.field for f in asked if f.kind == "terms_count"})
    out = out.join(queries.select("item_id", F.size(X.analysed("text", "plain")).alias("tokens:"), *[
        F.size(F.array_distinct(X.analysed("text", X.analyzer_of(c)))).cast("double").alias(f"terms_count:{c}") for c in counted]), "item_id", "left")
    valued = sorted({f.field for f in asked if f.kind == "field_value"})
    bad = F.lit(False)
    if values is not None:
        unreadable = [F.col("unreadable").alias("unreadable:")] if "unreadable" in values.columns else []
        own = values.select("doc_id", *unreadable, *[F.col(v).try_cast("double").alias(f"field_value:{v}") for v in valued],
                            *[(F.col(v).isNotNull() & F.col(v).try_cast("double").isNull()).alias(f"bad:{v}") for v in valued])
        out = out.join(own, "doc_id", "left")
        bad = F.coalesce(F.col(_quoted("unreadable:")), F.lit(False)) if unreadable else bad
    for f in asked:
        if f.kind == "external":
            own = (tables or {})[f.params["table"]].select(*f.params["on"], F.col(f.field).cast("double").alias(_source(f)), F.lit(True).alias(f"here:{f.name}"))
            out = out.join(own, f.params["on"], "left")
    if explored:
        # many columns: joined last, a row a language and set of equal queries
        fields, stats, aggs = (sorted({x(f) for f in explored}) for x in (
            lambda f: f.field, lambda f: f.params["stat"], lambda f: f.params["agg"]))
        terms = index.asked(queries, fields)
        place = {(f, s, a): i for i, (f, s, a) in enumerate((f, s, a) for f in fields for s in stats for a in aggs)}
        out = out.join(terms.members.withColumnRenamed("of", "of:"), "item_id", "left")
        own = cand.select("lang", "item_id").distinct().join(terms.members, "item_id")
        found = X.statistics(terms, fields, stats, aggs, own).select("lang", F.col("of").alias("of:"), *[
            F.get("value", F.lit(place[f.field, f.params["stat"], f.params["agg"]])).alias(_source(f)) for f in explored])
        out = out.join(found, ["lang", "of:"], "left")
    of_document = {"match", "phrase", "field_value"}
    statuses: dict[str, Column] = {}
    columns: dict[str, Column] = {}
    for f, source in zip(features, asked):
        if f.kind == "derived":
            continue
        found = F.col(_quoted(_source(source)))
        status = F.when(found.isNull(), F.lit(NO_MATCH)).otherwise(F.lit(VALUE))
        if source.kind in of_document:
            status = F.when(bad, F.lit(FAILED)).otherwise(status)
        if source.kind == "field_value" and values is not None:
            status = F.when(F.coalesce(F.col(_quoted(f"bad:{source.field}")), F.lit(False)), F.lit(FAILED)).otherwise(status)
        if source.kind == "external":
            status = F.when(F.col(_quoted(f"here:{source.name}")).isNull(), F.lit(ABSENT)).when(found.isNull(), F.lit(FAILED)).otherwise(F.lit(VALUE))
        if f.kind == "token_router":
            routed = (F.col(_quoted("tokens:")) > 1) & (F.col(_quoted("tokens:")) <= f.params.get("limit", 10))
            status = F.when(routed, status).otherwise(F.lit(NO_MATCH))
        statuses[f.name] = status.cast("tinyint")
        columns[f.name] = F.when(status >= FAILED, F.lit(float("nan"))).when(status == NO_MATCH, F.lit(0.0)).otherwise(found)
    direct = out.select(*k, *[c.alias(n) for n, c in columns.items()], *[c.alias(f"status:{n}") for n, c in statuses.items()])
    for f in features:
        if f.kind == "derived":
            used = used_features(f, [g.name for g in features])
            worst = F.greatest(*[F.col(_quoted(f"status:{u}")) for u in used], F.lit(VALUE).cast("tinyint"))
            failed = worst >= FAILED
            direct = direct.withColumns({
                f.name: F.when(failed, F.lit(float("nan"))).otherwise(derived(f.params["expression"]).cast("double")),
                f"status:{f.name}": F.when(failed, worst).otherwise(F.lit(VALUE).cast("tinyint"))})
    names = [f.name for f in features]
    done = direct.select(*k, *names, array_to_vector(F.array(*[F.col(n) for n in names])).alias("features"),
                         F.array(*[F.col(_quoted(f"status:{n}")) for n in names]).alias("status"))
    return with_column_metadata(done, "features", {"features": names})


def _source(f: Feature) -> str:
    if f.kind == "explorer":
        return f"explorer:{f.field}:{f.params['agg']}_{f.params['stat']}"
    return f"external:{f.name}" if f.kind == "external" else f"{f.kind}:{f.field}"


def _quoted(name: str) -> str:
    return f"`{name}`"


def status_counts(rows: DataFrame) -> DataFrame:
    """``feature, n_values, n_no_match, n_failed`` of collected rows; ``n_values`` counts what was collected (found,
    not found or failed), so a feature that was not computed for a row has fewer (see :func:`assert_complete`)."""
    names = F.array(*[F.lit(n) for n in feature_names(rows)])
    long = rows.select(F.posexplode("status").alias("at", "s")).withColumn("feature", F.get(names, F.col("at")))

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0)).cast("long")

    return long.groupBy("feature").agg(count(F.col("s") != ABSENT).alias("n_values"), count(F.col("s") == NO_MATCH).alias("n_no_match"),
                                       count(F.col("s") == FAILED).alias("n_failed"))


def drop_failed(rows: DataFrame) -> DataFrame:
    """Rows without a failed or absent feature."""
    return rows.where(~F.exists("status", lambda s: s >= FAILED))


def feature_completeness(rows: DataFrame, names: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Number of collected (non-null) values per feature name, over the
    unpivoted rows; all counts must be equal (see :func:`assert_complete`)."""
    long = rows.unpivot(list(keys), list(names), "feature", "value")
    return long.groupBy("feature").agg(F.count("value").alias("n_values"))


def assert_complete(counts: DataFrame) -> list[str]:
    rows = counts.collect()  # one row per feature name
    if len({r.n_values for r in rows}) > 1:
        raise ValueError(f"features collected unequally: {[(r.feature, r.n_values) for r in rows]}")
    return sorted(r.feature for r in rows)


def append_features(df: DataFrame, *cols: str, features_col: str = "features") -> DataFrame:
    """Append scalar columns to the vector and to its name list."""
    names = feature_names(df, features_col) + list(cols)
    arr = F.concat(vector_to_array(F.col(features_col)), F.array(*[F.col(c).cast("double") for c in cols]))
    out = df.withColumn(features_col, array_to_vector(arr))
    return with_column_metadata(out, features_col, {"features": names})


def zero_features(df: DataFrame, *names: str, features_col: str = "features") -> DataFrame:
    """P10: set the named features to 0 (metadata kept)."""
    all_names = feature_names(df, features_col)
    idx = [all_names.index(n) for n in names]
    meta = dict(df.schema[features_col].metadata)
    arr = F.transform(vector_to_array(F.col(features_col)),
                      lambda x, i: F.when(i.isin(idx), F.lit(0.0)).otherwise(x))
    return df.withColumn(features_col, array_to_vector(arr)).withMetadata(features_col, meta)


def explode_features(df: DataFrame, names: Sequence[str] | None = None,
                     features_col: str = "features") -> DataFrame:
    """One float32 column per feature (all, or the named ones)."""
    all_names = feature_names(df, features_col)
    names = list(names) if names is not None else all_names
    arr = vector_to_array(F.col(features_col), "float32")
    return df.select(*[c for c in df.columns if c != features_col],
                     *[arr[all_names.index(n)].alias(n) for n in names])


def assemble(df: DataFrame, names: Sequence[str], features_col: str = "features") -> DataFrame:
    """Re-assemble chosen float columns into the vector (order = names)."""
    out = df.withColumn(features_col, array_to_vector(F.array(*[F.col(n).cast("double") for n in names])))
    out = out.drop(*[n for n in names if n != features_col])
    return with_column_metadata(out, features_col, {"features": list(names)})


def assemble_per_wiki(df: DataFrame, wiki_features: dict[str, Sequence[str]], wiki_col: str = "wikiid",
                      features_col: str = "features") -> DataFrame:
    """P12 with a per-wiki selection (``wiki_features`` metadata overrides
    ``features``): each wiki keeps only its chosen features, in its order; a wiki that is
    not listed keeps all of them.
    Done with one array expression (no per-wiki union)."""
    all_names = feature_names(df, features_col)
    arr = vector_to_array(F.col(features_col))
    picked = None
    for wiki, names in wiki_features.items():
        sel = F.array(*[arr[all_names.index(n)] for n in names])
        picked = (F.when(F.col(wiki_col) == wiki, sel) if picked is None
                  else picked.when(F.col(wiki_col) == wiki, sel))
    out = df if picked is None else df.withColumn(features_col, array_to_vector(picked.otherwise(arr)))
    meta = dict(df.schema[features_col].metadata)
    meta["wiki_features"] = {w: list(n) for w, n in wiki_features.items()}
    return with_column_metadata(out, features_col, meta)


def token_counts(queries: DataFrame, query_col: str = "query") -> DataFrame:
    """Query-level token counts under two analyzers, computed once per
    distinct query (J7: join the result back onto any dataset)."""
    distinct = queries.select(query_col).distinct()
    return distinct.select(
        query_col,
        F.size(R.analyze(query_col, "plain")).alias("tokens_plain"),
        F.size(F.filter(F.split(F.col(query_col), r"\s+"),
                        lambda t: F.length(t) > 0)).alias("tokens_whitespace"))


def union_distinct_queries(*frames: DataFrame, query_col: str = "query") -> DataFrame:
    """Union of query columns from several datasets, deduplicated."""
    out = None
    for f in frames:
        q = f.select(query_col)
        out = q if out is None else out.unionByName(q)
    return out.distinct()


def join_features(labeled: DataFrame, feature_rows: DataFrame,
                  keys: Sequence[str] = ("wikiid", "query", "hit_page_id")) -> DataFrame:
    """Labeled hits ⋈ collected features on (wikiid, query, hit_page_id);
    the vector column's metadata (feature names) is kept."""
    return labeled.join(feature_rows, list(keys))
