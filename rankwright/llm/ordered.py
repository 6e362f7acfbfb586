"""Documents dealt out in ascending ``doc_id`` order over numbered ranges.

Range ``i`` holds smaller ids than range ``i + 1``; each range is one partition, sorted
inside.  The cuts come from approximate percentiles of the ids (an aggregate), one range for
each shuffle partition of the session, so range sizes follow the usual Spark setting.
A null id sorts before all others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALLEST = -(1 << 63)


def order_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(SMALLEST))


def cuts(docs: DataFrame, ranges: int) -> list[int]:
    """At most ``ranges - 1`` increasing ids that divide the documents evenly."""
    if ranges < 2:
        return []
    marks = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    got = docs.agg(F.percentile_approx(order_key(F.col("doc_id")), marks, F.lit(max(10000, 20 * ranges)))).first()[0]
    return sorted(set(got or []))


def range_of(key: Column, at: list[int]) -> Column:
    """Number of the range of an order key."""
    edges = np.array(at, dtype=np.int64)

    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    return number(key)


def shuffle_partitions(docs: DataFrame) -> int:
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def deal(rows: DataFrame, ranges: int, *order: str) -> DataFrame:
    """Rows with a ``range`` column, one partition a range, sorted by ``order`` inside."""
    return rows.repartitionById(ranges, F.col("range")).sortWithinPartitions(*order)
