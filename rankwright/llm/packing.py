"""Best-fit packing under conflicts.

Documents become pieces of at most ``capacity`` units (whole pieces of exactly
``capacity`` units, then one remainder); pieces go into bins of ``capacity``.  No
bin holds two documents of one source, nor two of one duplicate cluster.  Clusters are
the components of near duplicates (``neardup``, similarity 0.8 on full sets); texts without
a word form one with their exact copies.

Method: inside a shard, pieces come in decreasing size.  Open bins stand in
residual order; each carries a bitmap of its sources and one of its clusters.  The
search starts at the smallest residual that fits and goes on to its successors
until it meets a compatible bin, which is the tightest compatible one; without one
a bin is opened.

Scale: shards are hash classes of ``doc_id`` and hold about ``shard_rows`` documents
whatever the table's size, so the number of shards grows with the input and the
packing of a shard stays bounded; a hot source or cluster is spread over all shards.
For the bins only ids, sizes, sources and cluster ids are shuffled, never texts; the
clusters cost what ``neardup`` costs.

Edge cases: null text or size counts as 0 units and still gets its place; a null
source conflicts with nothing; a null cluster (that of a null text) likewise; repeated rows are packed as
rows of their own (equal texts never share a bin); ties in size are ordered by doc_id,
then cluster; an empty table gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import neardup

CAPACITY = 8192
SHARD_ROWS = 4096
CLUSTER_PERCENT = 80
NO_ID = -(1 << 63)  # stands for a null doc_id inside the shards
SCHEMA = ("doc_id bigint, piece bigint, start bigint, size bigint, source string, cluster bigint, "
          "bin_id bigint, bin_used bigint")


class Bins:
    """Open bins of one shard in residual order, with conflict bitmaps."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, bin), ascending
        self.used: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source_bit: int, cluster_bit: int) -> int:
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            _, b = self.order[at]
            if not (self.sources[b] & source_bit or self.clusters[b] & cluster_bit):
                del self.order[at]
                break
            at += 1
        else:
            b = len(self.used)
            self.used.append(0)
            self.sources.append(0)
            self.clusters.append(0)
        self.used[b] += size
        self.sources[b] |= source_bit
        self.clusters[b] |= cluster_bit
        if self.used[b] < self.capacity:
            insort(self.order, (self.capacity - self.used[b], b))
        return b


def pack_shard(rows: list[tuple], capacity: int) -> tuple[list[tuple], list[int]]:
    """Pack ``(doc_id, size, source, cluster)`` rows.

    Gives ``(row, piece, start, size, bin)`` tuples and the units used in each bin."""
    bins = Bins(capacity)
    source_bits: dict = {None: 0}
    cluster_bits: dict = {None: 0}
    out, rest = [], []
    for i, (_, size, source, cluster) in enumerate(rows):
        source_bits.setdefault(source, 1 << (len(source_bits) - 1))
        cluster_bits.setdefault(cluster, 1 << (len(cluster_bits) - 1))
        full, tail = divmod(size, capacity)
        for p in range(full):
            out.append((i, p, p * capacity, capacity, bins.place(capacity, source_bits[source], cluster_bits[cluster])))
        if tail or not full:
            rest.append((-tail, rows[i][0], rows[i][3] or 0, i, full))
    for neg, _, _, i, piece in sorted(rest):
        b = bins.place(-neg, source_bits[rows[i][2]], cluster_bits[rows[i][3]])
        out.append((i, piece, piece * capacity, -neg, b))
    return out, bins.used


def _or_none(values) -> list:
    return [None if pd.isna(v) else v for v in values]


def pack(docs: DataFrame, size: Column, source: Column, cluster: Column, doc_id: str = "doc_id",
         capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pieces with their bins (``SCHEMA``); ``bin_id`` is unique over all shards."""
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        source.cast("string").alias("source"), cluster.cast("string").alias("cluster"))
    shards = max(1, -(-docs.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(shards)))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        # a stable order of the rows makes a recomputed shard give the same bins
        pdf = pdf.sort_values(["doc_id", "size", "cluster", "source"], kind="stable", na_position="first")
        clusters = _or_none(pdf["cluster"])
        clusters = [None if c is None else int(c) for c in clusters]
        rows = list(zip(pdf["doc_id"].tolist(), pdf["size"].tolist(), _or_none(pdf["source"]), clusters))
        placed, used = pack_shard(rows, capacity)
        base = int(pdf["shard"].iloc[0]) << 32
        take = [p[0] for p in placed]
        ids = pdf["doc_id"].to_numpy()
        return pd.DataFrame({
            "doc_id": ids[take], "piece": [p[1] for p in placed], "start": [p[2] for p in placed],
            "size": [p[3] for p in placed], "source": [rows[i][2] for i in take],
            "cluster": pd.array([clusters[i] for i in take], dtype="Int64"),
            "bin_id": [base + p[4] for p in placed], "bin_used": [used[p[4]] for p in placed]})

    packed = rows.groupBy("shard").applyInPandas(work, SCHEMA)
    return packed.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pack a ``documents`` frame: size in code points, clusters of near duplicates."""
    text = F.col("text").cast("string")
    exact = F.when(text.isNotNull(), F.xxhash64(text))
    rows = docs.select(  # rows without an id are clustered under a code of their text
        F.coalesce(F.col("doc_id").cast("long"), exact).alias("doc_id"), text.alias("text"), F.col("doc_id").cast("long").alias("id"),
        F.char_length(text).alias("units"), F.col("source").cast("string").alias("source"), exact.alias("exact"))
    rows = cut_lineage(neardup.components(rows, CLUSTER_PERCENT, ("id", "units", "source", "exact")).select(
        F.col("id").alias("doc_id"), "units", "source", F.coalesce("component_id", "exact").alias("cluster")))
    return pack(rows, F.col("units"), F.col("source"), F.col("cluster"), capacity=capacity, shard_rows=shard_rows)
