"""Column-level functions (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at_least_n_distinct(col, n: int, over=None) -> Column:
    """A3/UD5: true when the group (or the ``over`` window) holds at least
    ``n`` distinct non-null values of ``col``.  Usable in ``agg`` or, with
    ``over=Window...``, as a window expression.

    The set is per group; for groups that can hold a large share of the data
    prefer :func:`at_least_n_distinct_over` (sort based) or
    :func:`rankwright.operators.clicks.session_gate` (two-level aggregate).
    """
    values = F.collect_set(_col(col))
    if over is not None:
        values = values.over(over)
    return F.size(values) >= F.lit(n)


def at_least_n_distinct_over(col, n: int, partition_by: Sequence[str]) -> Column:
    """Window form of A3 that never materialises a set: dense rank over the
    partition sorted by the value (the sort spills), then the max rank is the
    distinct count.  Nulls are ranked last and ignored.
    """
    c = _col(col)
    ordered = Window.partitionBy(*partition_by).orderBy(c.asc_nulls_last())
    whole = Window.partitionBy(*partition_by)
    distinct_rank = F.when(c.isNotNull(), F.dense_rank().over(ordered))
    return F.coalesce(F.max(distinct_rank).over(whole), F.lit(0)) >= F.lit(n)


def relevance_label(relevance) -> Column:
    """Naive relevance → integer label, truncating (0..9, 10 only at 1.0)."""
    return (_col(relevance) * 10).cast("int")


def query_key(*cols) -> Column:
    """Collision-free composite query id: the values as a JSON array, nulls included."""
    return F.to_json(F.array(*[_col(c).cast("string") for c in cols]))


def parse_compact_ts(col) -> Column:
    """``yyyyMMddHHmmss`` string (UTC) → unix seconds (bigint); malformed
    → null.  Parsed with an explicit offset, so the session time zone does not
    matter."""
    return F.unix_seconds(F.try_to_timestamp(F.concat(_col(col), F.lit("+0000")), F.lit("yyyyMMddHHmmssZ")))


# Light suffix rules of the default query normaliser, per language
# (longest first).  A real language stemmer can be plugged in with
# ``normalise_query(col, lang, stemmer=...)``.
SUFFIXES = {
    "en": ["ing", "es", "s"],
    "de": ["en", "er", "e"],
    "fr": ["es", "s", "e"],
    "es": ["es", "s"],
}
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(col) -> Column:
    """Lower-cased letter/digit tokens of a text (empty tokens removed)."""
    return F.filter(F.split(F.lower(_col(col)), TOKEN_SPLIT), lambda t: F.length(t) > 0)


def _strip_suffix(tok: Column, lang: Column) -> Column:
    expr = tok
    for code, sfx in SUFFIXES.items():
        pattern = "(" + "|".join(sfx) + ")$"
        stripped = F.when(F.length(tok) > 4, F.regexp_replace(tok, pattern, "")).otherwise(tok)
        expr = F.when(lang == code, stripped).otherwise(expr)
    return expr


def normalise_query(col, lang, stemmer=None) -> Column:
    """P7/UD1: language-aware normal form of a query.

    Default (pure SQL): lower-case, split on non letters/digits, strip one
    language suffix from tokens longer than 4 characters, then the sorted set
    of tokens joined by a space.  ``stemmer`` may be a Column-returning
    function ``(tokens_array, lang) -> array`` (e.g. a registered pandas UDF).
    """
    lang_c = F.substring(_col(lang), 1, 2)
    toks = tokens(col)
    if stemmer is None:
        stemmed = F.transform(toks, lambda t: _strip_suffix(t, lang_c))
    else:
        stemmed = stemmer(toks, lang_c)
    return F.array_join(F.array_sort(F.array_distinct(stemmed)), " ")


def with_column_metadata(df: DataFrame, column: str, metadata: dict) -> DataFrame:
    """Attach JSON metadata to a column; survives Parquet round trips."""
    merged = dict(df.schema[column].metadata)
    merged.update(metadata)
    return df.withMetadata(column, merged)
