"""Boosted ranking trees on gradient histograms (M12): the numpy steps and the jobs around them.

Rows lie in blocks of whole queries (``layout``) with their features as bin numbers.  A round
takes the lambda gradients of NDCG@10 (pairs with one member among the ten first of the current
order, O(10 n) a query), and grows one tree level by level: sums of gradient and hessian by
(model, node, feature, bin), best split of each node, children.  ``min_child_weight`` bounds a child's
hessian sum; ``colsample`` draws features a tree, ``subsample`` rows a tree.

Many models (folds x candidates) advance together; the model is a key of the sums.  Gradients are
rounded to whole multiples of 2**-24, so sums are exact and a split does not depend on how
the rows are divided.  Data of one block is trained inside the task that holds it (models are dealt
over tasks); larger data by one job a level, whose histograms are summed by Spark.  Both call the
same steps and give equal trees (a test holds them together).

A query's rows are in one block, so one query must fit in a task.  Missing values (NaN) go right.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

TOP = 10
REG_LAMBDA = 1.0
FIXED = float(1 << 24)
MIN_GAIN = 1e-6
BLOCK_VALUES = 32 << 20
KEEP_SCORES_EVERY = 10
_BLOCKS = "block int, bins binary, labels binary, sizes binary, folds binary, wikis array<string>"
METRICS = "model int, round int, test boolean, wiki string, ndcg_sum double, n_queries bigint"
_METRICS = pa.schema([("model", pa.int32()), ("round", pa.int32()), ("test", pa.bool_()), ("wiki", pa.string()),
                      ("ndcg_sum", pa.float64()), ("n_queries", pa.int64())])


@dataclass
class Spec:
    """Parameters of one model; queries of fold ``held_out`` are left out of its training."""
    rounds: int
    eta: float = 0.3
    max_depth: int = 6
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    seed: int = 0
    held_out: int = -1


@dataclass
class Tree:
    """Nodes in heap order (root 1, children ``2k`` and ``2k + 1``): a row goes left when its bin is at most ``bin``."""
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> "Tree":
        size = 2 << depth
        return cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node each row ends in, as far as the tree has grown."""
        node = np.ones(len(bins), np.int64)
        rows = np.arange(len(bins))
        while len(rows):
            f = self.feature[node[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            at = node[rows]
            node[rows] = 2 * at + (bins[rows, f] > self.bin[at])
        return node


@dataclass
class Block:
    """Whole queries: bins (rows x features), labels, first row of each query, its fold and wiki."""
    number: int
    bins: np.ndarray
    labels: np.ndarray
    starts: np.ndarray
    folds: np.ndarray
    wikis: list
    ideal: np.ndarray = field(init=False)

    def __post_init__(self):
        self.ideal = ideal_dcg(self.labels, self.starts)

    def queries(self, keep: np.ndarray) -> tuple["Block", np.ndarray]:
        """The block of some of the queries, and which rows it has."""
        sizes = np.diff(self.starts)
        rows = np.repeat(keep, sizes)
        part = Block(self.number, self.bins[rows], self.labels[rows], np.concatenate([[0], np.cumsum(sizes[keep])]),
                     self.folds[keep], [w for w, k in zip(self.wikis, keep) if k])
        return part, rows


def _order(scores: np.ndarray, labels: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by query and falling score (ties: the lower label first), the query of each and its rank from 0."""
    query = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((labels, -scores, query))
    return order, query, np.arange(len(query)) - starts[query]


def _dcg(labels: np.ndarray, query: np.ndarray, rank: np.ndarray, queries: int) -> np.ndarray:
    first = rank < TOP
    return np.bincount(query[first], (2.0 ** labels[first] - 1) / np.log2(rank[first] + 2), queries)


def ideal_dcg(labels: np.ndarray, starts: np.ndarray) -> np.ndarray:
    order, query, rank = _order(labels, labels, starts)
    return _dcg(labels[order], query, rank, len(starts) - 1)


def ndcg(scores: np.ndarray, block: Block) -> np.ndarray:
    """NDCG@10 of each query; 0 where no document has a gain."""
    order, query, rank = _order(scores, block.labels, block.starts)
    got = _dcg(block.labels[order], query, rank, len(block.starts) - 1)
    return np.divide(got, block.ideal, out=np.zeros(len(got)), where=block.ideal > 0)


def lambdas(scores: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of each row: over pairs of unequal label with one member among the first
    ``TOP``, the change of NDCG by swapping them times the logistic of their score difference."""
    order, query, rank = _order(scores, block.labels, block.starts)
    s, gain = scores[order], 2.0 ** block.labels[order] - 1
    discount = np.where(rank < TOP, 1 / np.log2(rank + 2.0), 0.0)
    weight = np.divide(1.0, block.ideal, out=np.zeros(len(block.ideal)), where=block.ideal > 0)
    g, h = np.zeros(len(s)), np.zeros(len(s))
    sizes = np.diff(block.starts)
    for r in range(TOP):
        if not (sizes > r + 1).any():
            break
        low = np.flatnonzero(rank > r)
        top = block.starts[query[low]] + r
        apart = gain[top] - gain[low]
        some = np.flatnonzero(apart)
        low, top, apart = low[some], top[some], apart[some]
        sign = np.sign(apart)
        change = np.abs(apart) * (discount[top] - discount[low]) * weight[query[low]]
        wrong = 1 / (1 + np.exp(np.clip((s[top] - s[low]) * sign, -500, 500)))
        force, bend = wrong * change * sign, wrong * (1 - wrong) * change
        g[low] += force
        h[low] += bend
        own = query[top]
        first = block.starts[:-1][sizes > r] + r
        g[first] -= np.bincount(own, force, len(sizes))[sizes > r]
        h[first] += np.bincount(own, bend, len(sizes))[sizes > r]
    out_g, out_h = np.empty(len(s)), np.empty(len(s))
    out_g[order], out_h[order] = np.rint(g * FIXED), np.rint(h * FIXED)
    return out_g, out_h


def drawn_features(spec: Spec, rnd: int, features: int) -> np.ndarray:
    count = max(1, round(spec.colsample * features))
    if count >= features:
        return np.arange(features)
    return np.sort(np.random.default_rng([spec.seed, rnd, 1]).permutation(features)[:count])


def drawn_rows(spec: Spec, rnd: int, block: Block) -> np.ndarray:
    return np.random.default_rng([spec.seed, rnd, 2, block.number]).random(len(block.labels)) < spec.subsample


def histograms(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, n_bins: int) -> np.ndarray:
    """Sums of ``g`` and ``h`` by (slot, feature, bin): array (2, slots, features, bins)."""
    features = bins.shape[1]
    code = ((slot[:, None] * features + np.arange(features)) * n_bins + bins).ravel()
    size = slots * features * n_bins
    return np.stack([np.bincount(code, np.repeat(x, features), size) for x in (g, h)]).reshape(2, slots, features, n_bins)


def best_splits(sums: np.ndarray, min_child_weight: float) -> list[tuple]:
    """For each slot of ``sums`` (2, slots, features, bins): ``(gain, feature, bin, g, h, g_left, h_left)``, sums as whole
    multiples of 1 / FIXED; of equal gains the first feature and bin.  A slot without a split has gain 0."""
    total = sums[:, :, 0, :].sum(axis=2)
    left = np.cumsum(sums, axis=3)[..., :-1]
    out = []
    if not left.shape[3]:
        return [(0.0, -1, 0, int(total[0, i]), int(total[1, i]), 0, 0) for i in range(sums.shape[1])]
    gl, hl = left / FIXED
    g, h = (total / FIXED)[:, :, None, None]
    gr, hr = g - gl, h - hl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl * gl / (hl + REG_LAMBDA) + gr * gr / (hr + REG_LAMBDA) - g * g / (h + REG_LAMBDA)
    gain = np.where((hl >= min_child_weight) & (hr >= min_child_weight) & (hl > 0) & (hr > 0), gain, 0.0)
    for i in range(sums.shape[1]):
        f, b = np.unravel_index(int(np.argmax(gain[i])), gain[i].shape)
        out.append((float(gain[i, f, b]), int(f), int(b), int(total[0, i]), int(total[1, i]),
                    int(left[0, i, f, b]), int(left[1, i, f, b])))
    return out


def leaf_value(g: int, h: int, eta: float) -> float:
    return -eta * (g / FIXED) / (h / FIXED + REG_LAMBDA)


def extend(tree: Tree, spec: Spec, splits: dict[int, tuple]) -> list[int]:
    """Put the splits ``{node: (gain, feature, bin, g, h, g_left, h_left)}`` into the tree; the new nodes."""
    grown = []
    for node, (gain, f, b, g, h, g_left, h_left) in splits.items():
        tree.value[node] = leaf_value(g, h, spec.eta)
        if gain > MIN_GAIN:
            tree.feature[node], tree.bin[node] = f, b
            tree.value[2 * node] = leaf_value(g_left, h_left, spec.eta)
            tree.value[2 * node + 1] = leaf_value(g - g_left, h - h_left, spec.eta)
            grown += [2 * node, 2 * node + 1]
    return grown


def level_sums(block: Block, g: np.ndarray, h: np.ndarray, tree: Tree, open_nodes: Sequence[int], columns: np.ndarray,
               rows: np.ndarray | None, n_bins: int) -> np.ndarray:
    """Histograms of the rows in ``open_nodes`` (in that order) over the features ``columns``."""
    slot_of = np.full(len(tree.feature), -1, np.int64)
    slot_of[list(open_nodes)] = np.arange(len(open_nodes))
    slot = slot_of[tree.leaves(block.bins)]
    keep = slot >= 0 if rows is None else (slot >= 0) & rows
    bins = block.bins[keep] if len(columns) == block.bins.shape[1] else block.bins[np.ix_(keep, columns)]
    return histograms(bins, slot[keep], g[keep], h[keep], len(open_nodes), n_bins)


def train_here(blocks: list[Block], spec: Spec, n_bins: int, model: int, every: int = 0) -> tuple[list[Tree], list[dict]]:
    """All rounds of one model on blocks at hand: its trees and metric rows (after every ``every`` rounds and the last)."""
    parts = [b.queries(b.folds != spec.held_out) for b in blocks]
    scores = [np.zeros(len(b.labels)) for b in blocks]
    trees: list[Tree] = []
    metrics: list[dict] = []
    for rnd in range(spec.rounds):
        columns = drawn_features(spec, rnd, blocks[0].bins.shape[1] if blocks else 1)
        grads = [lambdas(s[rows], part) for s, (part, rows) in zip(scores, parts)]
        picked = [drawn_rows(spec, rnd, part) if spec.subsample < 1 else None for part, _ in parts]
        tree, open_nodes = Tree.of_depth(spec.max_depth), [1]
        for _ in range(spec.max_depth):
            if not open_nodes:
                break
            sums = sum(level_sums(part, g, h, tree, open_nodes, columns, some, n_bins)
                       for (part, _), (g, h), some in zip(parts, grads, picked))
            found = [(gain, int(columns[f]) if f >= 0 else f, *rest) for gain, f, *rest in best_splits(sums, spec.min_child_weight)]
            open_nodes = extend(tree, spec, dict(zip(open_nodes, found)))
        trees.append(tree)
        for s, b in zip(scores, blocks):
            s += tree.value[tree.leaves(b.bins)]
        if rnd + 1 == spec.rounds or every and (rnd + 1) % every == 0:
            for s, b in zip(scores, blocks):
                metrics += metric_rows(s, b, spec, model, rnd + 1)
    return trees, metrics


def metric_rows(scores: np.ndarray, block: Block, spec: Spec, model: int, rnd: int) -> list[dict]:
    """Summed NDCG@10 of the block's queries by wiki, of training and held-out folds."""
    found: dict[tuple, list] = {}
    for value, wiki, test in zip(ndcg(scores, block).tolist(), block.wikis, (block.folds == spec.held_out).tolist()):
        cell = found.setdefault((test, wiki), [0.0, 0])
        cell[0] += value
        cell[1] += 1
    return [{"model": model, "round": rnd, "test": t, "wiki": w, "ndcg_sum": s, "n_queries": n} for (t, w), (s, n) in found.items()]


# ------------------------------------------------------------------ Spark side
def bin_edges(df: DataFrame, features_col: str, max_bin: int) -> list[np.ndarray]:
    """At most ``max_bin - 1`` rising edges a feature, from one aggregate of approximate percentiles."""
    values = vector_to_array(F.col(features_col))
    size = df.select(F.size(values).alias("n")).agg(F.max("n")).first()[0] or 0
    marks = F.array(*[F.lit(i / max_bin) for i in range(1, max_bin)])
    finite = [F.when(~F.isnan(values[i]), values[i]) for i in range(size)]
    if not finite or max_bin < 2:
        return [np.zeros(0)] * size
    row = df.agg(*[F.percentile_approx(v, marks, F.lit(max(10000, 40 * max_bin))).alias(f"e{i}") for i, v in enumerate(finite)]).first()
    return [np.unique(np.array(e or [], dtype=float)) for e in row]


def layout(df: DataFrame, edges: list[np.ndarray], label_col: str, features_col: str, group: Sequence[str],
           fold_col: str | None = None, block_values: int = BLOCK_VALUES) -> tuple[DataFrame, int]:
    """Blocks of whole queries (``_BLOCKS``) and their number.  Rows of a query are in an order that only depends
    on their values; a null label is 0."""
    if max([0, *map(len, edges)]) > 255:
        raise ValueError("at most 256 bins a feature")
    values = vector_to_array(F.col(features_col))
    count = df.count()
    blocks = max(1, -(-count * len(edges) // block_values))
    fold = F.coalesce(F.col(fold_col).cast("int"), F.lit(-2)) if fold_col else F.lit(0)
    # rows of one query in two folds are two queries
    query = F.to_json(F.array(*[F.col(c).cast("string") for c in group], fold.cast("string")))
    rows = df.select(query.alias("query"), F.col(group[0]).cast("string").alias("wiki"), fold.alias("fold"),
                     F.coalesce(F.col(label_col).cast("double"), F.lit(0.0)).alias("label"), values.alias("x"),
                     F.pmod(F.xxhash64(query), F.lit(blocks)).cast("int").alias("block"), F.xxhash64(values).alias("tie"))
    schema = pa.schema([("block", pa.int32()), *[(c, pa.binary()) for c in ("bins", "labels", "sizes", "folds")], ("wikis", pa.list_(pa.string()))])

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("query", "ascending"), ("tie", "ascending"), ("label", "ascending")])
        n = table.num_rows
        x = table.column("x").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(n, len(edges))
        bins = np.empty((n, len(edges)), np.uint8)
        for i, e in enumerate(edges):
            bins[:, i] = np.searchsorted(e, x[:, i], side="left")
        query = table.column("query").to_pylist()
        first = [i for i in range(n) if i == 0 or query[i] != query[i - 1]]
        folds, wikis = table.column("fold").to_numpy(), table.column("wiki").to_pylist()
        sizes = np.diff([*first, n]).astype(np.int64)
        return pa.Table.from_pylist([{
            "block": table.column("block")[0].as_py(), "bins": bins.tobytes(), "labels": table.column("label").to_numpy().astype(float).tobytes(),
            "sizes": sizes.tobytes(), "folds": folds[first].astype(np.int64).tobytes(), "wikis": [wikis[i] for i in first]}], schema=schema)

    return cut_lineage(rows.groupBy("block").applyInArrow(build, _BLOCKS)), blocks


def _block(row: dict) -> Block:
    sizes = np.frombuffer(row["sizes"], np.int64)
    labels = np.frombuffer(row["labels"], float)
    bins = np.frombuffer(row["bins"], np.uint8)
    return Block(row["block"], bins.reshape(len(labels), -1), labels, np.concatenate([[0], np.cumsum(sizes)]),
                 np.frombuffer(row["folds"], np.int64), row["wikis"])


def fit_models(blocks: DataFrame, n_blocks: int, specs: Sequence[Spec], n_bins: int, every: int = 0,
               whole: bool | None = None) -> tuple[list[list[Tree]], DataFrame]:
    """Trees of every model, and ``METRICS`` rows after every ``every`` rounds and the last.

    ``whole`` trains in the tasks that hold all blocks (default: when there is one block)."""
    return (_fit_whole if (n_blocks == 1 if whole is None else whole) else _fit_by_levels)(blocks, list(specs), n_bins, every)


def _fit_whole(blocks: DataFrame, specs: list[Spec], n_bins: int, every: int) -> tuple[list[list[Tree]], DataFrame]:
    spark = blocks.sparkSession
    chunks = max(1, min(len(specs), spark.sparkContext.defaultParallelism * 4))
    order = sorted(range(len(specs)), key=lambda m: -specs[m].rounds * 2 ** specs[m].max_depth)
    schema = "model int, trees binary, metrics array<struct<model:int,round:int,test:boolean,wiki:string,ndcg_sum:double,n_queries:bigint>>"
    arrow = pa.schema([("model", pa.int32()), ("trees", pa.binary()), ("metrics", pa.list_(pa.struct(list(_METRICS))))])

    def work(table: pa.Table) -> pa.Table:
        own = sorted((_block(r) for r in table.to_pylist()), key=lambda b: b.number)
        out = []
        for model in order[table.column("chunk")[0].as_py()::chunks]:
            trees, metrics = train_here(own, specs[model], n_bins, model, every)
            out.append({"model": model, "trees": pack_trees(trees), "metrics": metrics})
        return pa.Table.from_pylist(out, schema=arrow)

    dealt = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).repartitionById(chunks, F.col("chunk"))
    fitted = cut_lineage(dealt.groupBy("chunk").applyInArrow(work, schema))
    trees = {r.model: unpack_trees(bytes(r.trees), specs[r.model].max_depth) for r in fitted.select("model", "trees").collect()}
    return [trees.get(m, []) for m in range(len(specs))], fitted.select(F.inline("metrics"))


def pack_trees(trees: list[Tree]) -> bytes:
    return b"".join(t.feature.tobytes() + t.bin.tobytes() + t.value.tobytes() for t in trees)


def unpack_trees(data: bytes, depth: int) -> list[Tree]:
    size = 2 << depth
    step = size * 16
    return [Tree(np.frombuffer(data, np.int32, size, at).copy(), np.frombuffer(data, np.int32, size, at + 4 * size).copy(),
                 np.frombuffer(data, float, size, at + 8 * size).copy()) for at in range(0, len(data), step)]


def _fit_by_levels(blocks: DataFrame, specs: list[Spec], n_bins: int, every: int) -> tuple[list[list[Tree]], DataFrame]:
    trees: list[list[Tree]] = [[] for _ in specs]
    state, done = blocks.withColumn("scores", F.lit(b"").cast("binary")), 0
    metrics = None

    def scores_of(row: dict, block: Block, pending: list[list[Tree]]) -> np.ndarray:
        held = np.frombuffer(row["scores"], float)
        scores = held.reshape(len(specs), -1).copy() if len(held) else np.zeros((len(specs), len(block.labels)))
        for model, own in enumerate(pending):
            for tree in own:
                scores[model] += tree.value[tree.leaves(block.bins)]
        return scores

    def level(rnd: int, growing: dict[int, Tree], open_nodes: dict[int, list[int]]) -> dict[int, dict[int, tuple]]:
        pending = [t[done:rnd] for t in trees]

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    whole = _block(row)
                    scores = scores_of(row, whole, pending)
                    for model, nodes in open_nodes.items():
                        spec = specs[model]
                        block, rows = whole.queries(whole.folds != spec.held_out)
                        g, h = lambdas(scores[model][rows], block)
                        some = drawn_rows(spec, rnd, block) if spec.subsample < 1 else None
                        columns = drawn_features(spec, rnd, block.bins.shape[1])
                        sums = level_sums(block, g, h, growing[model], nodes, columns, some, n_bins)
                        for i, node in enumerate(nodes):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([model] * len(columns), pa.int32()), pa.array([node] * len(columns), pa.int32()),
                                 pa.array(columns, pa.int32()), pa.array([sums[:, i, k].tobytes() for k in range(len(columns))], pa.binary())],
                                names=["model", "node", "feature", "sums"])

        def split(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_py(), float) for v in table.column("sums")).reshape(2, 1, 1, n_bins)
            gain, _, b, g, h, g_left, h_left = best_splits(total, specs[table.column("model")[0].as_py()].min_child_weight)[0]
            return pa.table({"model": table.column("model").slice(0, 1), "node": table.column("node").slice(0, 1),
                             "feature": table.column("feature").slice(0, 1), "gain": pa.array([gain]), "bin": pa.array([b], pa.int32()),
                             **{k: pa.array([v], pa.int64()) for k, v in (("g", g), ("h", h), ("gl", g_left), ("hl", h_left))}})

        sums = state.mapInArrow(build, "model int, node int, feature int, sums binary")
        found = sums.groupBy("model", "node", "feature").applyInArrow(
            split, "model int, node int, feature int, gain double, bin int, g bigint, h bigint, gl bigint, hl bigint")
        best = found.groupBy("model", "node").agg(F.max_by(
            F.struct("gain", "feature", "bin", "g", "h", "gl", "hl"), F.struct(F.col("gain"), -F.col("feature"))).alias("s"))
        out: dict[int, dict[int, tuple]] = {m: {} for m in open_nodes}
        for r in best.collect():  # one row an open node of a model
            out[r.model][r.node] = tuple(r.s)
        return out

    def measured(rnd: int) -> DataFrame:
        pending, at = [t[done:rnd] for t in trees], rnd

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    block = _block(row)
                    scores = scores_of(row, block, pending)
                    rows = [r for m, s in enumerate(specs) if at == s.rounds or at < s.rounds and every and at % every == 0
                            for r in metric_rows(scores[m], block, s, m, at)]
                    yield pa.RecordBatch.from_pylist(rows, schema=_METRICS)

        return cut_lineage(state.mapInArrow(build, METRICS).groupBy("model", "round", "test", "wiki").agg(
            F.sum("ndcg_sum").alias("ndcg_sum"), F.sum("n_queries").alias("n_queries")))

    def advance(rnd: int) -> DataFrame:
        pending = [t[done:rnd] for t in trees]

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = [scores_of(row, _block(row), pending).tobytes() for row in batch.to_pylist()]
                yield batch.set_column(batch.schema.get_field_index("scores"), "scores", pa.array(scores, pa.binary()))

        return cut_lineage(state.mapInArrow(build, state.schema))

    for rnd in range(max([0, *[s.rounds for s in specs]])):
        live = [m for m, s in enumerate(specs) if rnd < s.rounds]
        growing, open_nodes = {m: Tree.of_depth(specs[m].max_depth) for m in live}, {m: [1] for m in live}
        for depth in range(max(specs[m].max_depth for m in live)):
            asked = {m: nodes for m, nodes in open_nodes.items() if nodes and depth < specs[m].max_depth}
            if not asked:
                break
            found = level(rnd, growing, asked)
            open_nodes = {m: extend(growing[m], specs[m], found[m]) for m in asked}
        for m in live:
            trees[m].append(growing[m])
        if any(rnd + 1 == s.rounds for s in specs) or every and (rnd + 1) % every == 0:
            rows = measured(rnd + 1)
            metrics = rows if metrics is None else metrics.unionByName(rows)
        if rnd + 1 - done >= KEEP_SCORES_EVERY:
            state = advance(rnd + 1)
            done = rnd + 1
    return trees, metrics if metrics is not None else blocks.sparkSession.createDataFrame([], METRICS)
