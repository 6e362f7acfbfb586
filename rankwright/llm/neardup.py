"""Near duplicates by min-max hashing, banding and exact confirmation.

A document's set is its distinct 5-word shingles.  Under each of ``PERMUTATIONS`` random
permutations both the least and the greatest code are kept, so half the hash
evaluations give ``2 * PERMUTATIONS`` signature values, each equal between two documents with
the probability of their Jaccard similarity.  Bands of ``ROWS`` values are buckets: at
similarity 0.8 a pair shares none of the 20 buckets with probability 6e-7, at 0.85 5e-9.

From buckets to groups, without writing out pairs inside a group:

1. Documents of equal sets collapse to the smallest ``doc_id`` (map-side aggregation, so a
   hot group of copies costs one row a task).
2. Each bucket is a star: every member is compared with the bucket's smallest member.
   The comparison is exact, on the full sets.  Confirmed links give components.
3. Buckets whose members are then still in several components are compared exhaustively
   (only there, and only sets whose sizes allow the similarity), in blocks of ``BLOCK``
   members, so no task holds an unbounded bucket; each block task reports a spanning forest
   of the confirmed links.  Links inside one
   component cannot change it, so none that matters is missed.

Edge cases: null, empty or wordless texts have an empty set and link with nothing;
fewer than five words count as one shingle; ``doc_id`` is taken to be a key, and of rows that
share one each takes the component of its own text; a null ``doc_id`` gets its set size, no
component, and is kept;
an empty table gives an empty result; extra columns are not carried by
``near_duplicates`` and all kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut_lineage, retire
from . import textcodes

PERMUTATIONS = 30
ROWS = 3
PERCENT = 85
BLOCK = 256
TASK_ROWS = 4096
_U = np.uint64
_rng = np.random.default_rng(4711)
_SCALE = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * _U(2) + _U(1)
_SHIFT = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_MIXER = _rng.integers(1, 1 << 63, ROWS + 2, dtype=np.uint64) * _U(2) + _U(1)
PROFILE = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, buckets array<bigint>"


def signatures(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least and greatest permuted code of each non-empty set: ``2 * PERMUTATIONS`` rows."""
    out = np.empty((2 * PERMUTATIONS, len(starts)), dtype=np.uint64)
    for p in range(PERMUTATIONS):
        x = codes * _SCALE[p]
        x += _SHIFT[p]
        out[p] = np.minimum.reduceat(x, starts)
        out[PERMUTATIONS + p] = np.maximum.reduceat(x, starts)
    return out


def buckets(values: np.ndarray) -> np.ndarray:
    """Bucket codes (documents x bands); a band never holds two values of one permutation."""
    bands = len(values) // ROWS
    out = np.full((bands, values.shape[1]), 0, dtype=np.uint64)
    for r in range(ROWS):
        out += values[r * bands:(r + 1) * bands] * _MIXER[r]
    out += (np.arange(bands, dtype=np.uint64) * _MIXER[ROWS])[:, None]
    return textcodes.mix(out).T


def profile(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Set size, set key (128 bits) and buckets of each document (``PROFILE``, then the columns ``keep``)."""

    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for first, held in textcodes.blocks(batch.column("text").to_pylist()):
                codes, offset = textcodes.distinct_shingles(held)
                sizes = np.diff(offset)
                full = np.flatnonzero(sizes)
                starts = offset[:-1][full]
                k1, k2 = np.zeros(len(held), np.uint64), np.zeros(len(held), np.uint64)
                rows = np.zeros((0, 2 * PERMUTATIONS // ROWS), np.uint64)
                if len(full):
                    k1[full] = np.add.reduceat(textcodes.mix(codes * _MIXER[ROWS]), starts)
                    k2[full] = np.add.reduceat(textcodes.mix(codes + _MIXER[ROWS + 1]), starts)
                    rows = buckets(signatures(codes, starts))
                lists = np.concatenate([[0], np.cumsum(np.where(sizes > 0, rows.shape[1], 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(held)), pa.array(sizes.astype(np.int64)), pa.array(k1.view(np.int64)),
                     pa.array(k2.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(lists), pa.array(np.ascontiguousarray(rows).ravel().view(np.int64))),
                     *[batch.column(c).slice(first, len(held)) for c in keep]],
                    names=["doc_id", "n_shingles", "k1", "k2", "buckets", *keep])

    schema = PROFILE + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep) \
        .mapInArrow(scan, schema)


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_id, codes)`` of the ``wanted`` ids, written once: the sorted distinct shingle codes as bytes.

    Texts are shuffled once; what is written stays dealt by ``doc_id``, so joins on it do not move it again."""

    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for first, held in textcodes.blocks(batch.column("text").to_pylist()):
                codes, offset = textcodes.distinct_shingles(held)
                data = pa.array([codes[offset[i]:offset[i + 1]].tobytes() for i in range(len(held))], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(held)), data], names=["doc_id", "codes"])

    return cut_lineage(docs.join(wanted, "doc_id", "left_semi").mapInArrow(scan, "doc_id bigint, codes binary"))


def similar(a: bytes, b: bytes, percent: int) -> bool:
    """``100 * intersection >= percent * union`` of two sets of codes."""
    n, m = len(a) // 8, len(b) // 8
    if 100 * min(n, m) < percent * max(n, m):
        return False
    both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (n + m - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar."""

    @F.pandas_udf("boolean")
    def check(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(x, y, percent) for x, y in zip(a, b)], dtype=bool)

    left = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("codes").alias("cu")), "u")
    both = left.join(sets.select(F.col("doc_id").alias("v"), F.col("codes").alias("cv")), "v")
    return both.where(check("cu", "cv")).select("u", "v")


def _forest(ids: list, codes: list, guest: list, component: list, percent: int) -> list[tuple[int, int]]:
    """Spanning links between components among the members of two blocks of a cell.

    Each member's codes are marked and counted in all members before it at once.  Two
    guests are compared in the cell where they are at home."""
    sets = [np.frombuffer(c, np.uint64) for c in codes]
    size = np.array([len(c) for c in sets])
    start = np.cumsum(size) - size
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    label, away = np.array(component), np.array(guest)
    mark = np.zeros(int(code.max()) + 1, dtype=np.uint8)
    found = []
    for i in range(1, len(ids)):
        own = code[start[i]:start[i] + size[i]]
        mark[own] = 1
        shared = np.add.reduceat(mark[code[:start[i]]], start[:i], dtype=np.int64)
        mark[own] = 0
        near = 100 * shared >= percent * (size[:i] + size[i] - shared)
        near &= label[:i] != label[i]
        if guest[i]:
            near &= ~away[:i]
        for j in np.flatnonzero(near).tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                found.append((ids[i], ids[j]))
    return found


def _divided(rows: DataFrame, *place: str) -> DataFrame:
    """The places (buckets, cells) with members of several components, one for each distinct
    set of members, and their number of members."""
    found = rows.groupBy(*place).agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.bit_xor(F.xxhash64("rep")).alias("who")).where("lo < hi")
    return found.groupBy("n", "who").agg(F.min(F.struct(*place)).alias("p")).select("n", "p.*")


def _rest_links(members: DataFrame, component: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links between components inside buckets that the stars left divided.

    Similar sets have similar sizes, so a bucket falls into cells of one size class each
    (the class's members at home, those of the class below as guests): every pair whose
    sizes allow the similarity meets in one cell, and cells of one component are done.
    ``docs`` are texts or their :func:`full_sets`."""
    sets = docs if "codes" in docs.columns else full_sets(docs, members.select(F.col("rep").alias("doc_id")).distinct())
    named = members.join(component, members["rep"] == component["vertex"]).select("bucket", "rep", "n_shingles", "component")
    open_buckets = _divided(named, "bucket").where("n > 2").select("bucket")
    step = -float(np.log(percent / 100)) * 1.0001
    size_class = F.floor(F.log(F.col("n_shingles")) / step).cast("int")
    rows = named.join(open_buckets, "bucket").select(
        "bucket", "rep", "component", F.explode(F.array(
            F.struct(size_class.alias("cell"), F.lit(False).alias("guest")),
            F.struct((size_class + 1).alias("cell"), F.lit(True).alias("guest")))).alias("c")).select(
                "bucket", "rep", "component", "c.*")
    rows = by_cell = cut_lineage(rows)
    cells = _divided(rows, "bucket", "cell")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.join(cells, ["bucket", "cell"]).select(
        "bucket", "cell", F.col("rep").alias("doc_id"), "component", "guest", blocks.alias("blocks"),
        F.pmod(F.xxhash64("rep", "bucket"), blocks).cast("int").alias("own"))
    rows = rows.select("bucket", "cell", "doc_id", "component", "guest", "own",
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = cut_lineage(rows.select(
        F.xxhash64("bucket", "cell", F.least("own", "other"), F.greatest("own", "other")).alias("place"),
        "doc_id", "component", "guest").distinct())
    retire(by_cell)
    # a task takes whole places, about TASK_ROWS members together
    tasks = max(1, -(-rows.count() // TASK_ROWS))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "doc_id"])
        place = pdf["place"].to_numpy()
        columns = [pdf[c].tolist() for c in ("doc_id", "codes", "guest", "component")]
        edge = np.flatnonzero(np.append(True, place[1:] != place[:-1])).tolist() + [len(place)]
        found = [link for a, b in zip(edge, edge[1:]) for link in _forest(*(c[a:b] for c in columns), percent)]
        return pd.DataFrame(found, columns=["u", "v"])

    return rows.join(sets, "doc_id").withColumn("task", F.pmod("place", F.lit(tasks))) \
        .groupBy("task").applyInPandas(work, "u bigint, v bigint")


def components(docs: DataFrame, percent: int = PERCENT, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` and ``keep`` of every row of ``docs`` (``doc_id, text``, ``keep``).

    ``component_id`` is null for an empty set."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    found = cut_lineage(profile(docs, keep))
    docs = docs.select("doc_id", "text")
    reps = found.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.first("buckets").alias("buckets"))
    members = reps.select("rep", "n_shingles", F.explode("buckets").alias("bucket"))
    hubs = members.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub < top")
    members = cut_lineage(members.join(hubs.select("bucket", "hub"), "bucket"))
    pairs = cut_lineage(members.where("rep > hub").select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct())
    wanted = pairs.select(F.col("u").alias("doc_id")).union(pairs.select(F.col("v").alias("doc_id"))).distinct()
    sets = full_sets(docs, wanted)
    links = cut_lineage(_confirmed(pairs, sets, percent))
    stars = connected_components(links, "u", "v")
    alone = wanted.join(stars.select(F.col("vertex").alias("doc_id")), "doc_id", "left_anti") \
        .select(F.col("doc_id").alias("vertex"), F.col("doc_id").alias("component"))
    component = cut_lineage(stars.unionByName(alone))
    retire(pairs)
    rest = cut_lineage(_rest_links(members, component, sets, percent))
    if rest.take(1):
        component = cut_lineage(connected_components(links.union(rest), "u", "v"))
    nodes = cut_lineage(reps.join(component.withColumnRenamed("vertex", "rep"), "rep", "left").select(
        "k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    retire(members, sets, links, rest, component)
    # a hot set key is split by adaptive skew handling: both sides are plain shuffles
    return found.drop("buckets").join(nodes, ["k1", "k2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", "component_id", *keep)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (``doc_id, text``)."""
    return components(docs, percent).select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document (the smallest id) of each group."""
    gone = near_duplicates(docs, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
