"""Dynamic Bayesian network click model trained by EM (M3).

Semantics per (wikiid, norm_query_id): every page u has attractiveness a_u
and satisfaction s_u (start ``default_rel``); continue probability gamma.
E-step per session = forward-backward over examination states; M-step
a = A1/(A1+A0), s = S1/(S1+S0) with a +1/+1 prior; output relevance a·s.

Distribution:
* sessions with the same (pages, clicks) pattern are collapsed into one
  weighted row first (a partial aggregate, so hot queries shrink early);
* groups with at most ``max_patterns_per_task`` patterns run all iterations
  inside one ``applyInPandas`` call (numpy, vectorised over sessions);
* larger groups run the same EM as Spark iterations.  Up to ``SENT_PAGES`` pages of
  them the parameters are sent to every task: patterns are packed once (page
  numbers, clicks, weights, by length), a task sums the estimates of its patterns
  by page, and only these sums are shuffled.  With more pages the E-step joins the
  parameters (``mapInPandas`` over pattern rows) and the M-step is a ``groupBy`` sum.
  All paths compute the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, retire

GROUP = ("wikiid", "norm_query_id")
# Pages of large groups whose parameters are sent to every task.
SENT_PAGES = 500_000
# Patterns of an E-step at a time: its arrays stay in the cache.
STEP_PATTERNS = 4096
PACKED = "lengths binary, pages binary, clicks binary, weights binary"


def estep(a: np.ndarray, s: np.ndarray, clicks: np.ndarray, mask: np.ndarray, gamma: float):
    """Posterior attraction / satisfaction estimates for a batch of sessions.

    a, s, clicks, mask: arrays of shape (P, N); padded positions have mask False.
    Returns (est_a, est_s) of shape (P, N).
    """
    ea, es = _estep_t(np.ascontiguousarray(a.T), np.ascontiguousarray(s.T),
                      np.ascontiguousarray(clicks.T), np.ascontiguousarray(mask.T), gamma)
    return ea.T, es.T


def _estep_t(a, s, clicks, mask, gamma):
    """Position-major (N, P) forward-backward: every step reads contiguous rows."""
    n, p = a.shape
    inv = 1.0 - gamma
    not_a = 1.0 - a
    sat = s + inv * (1.0 - s)
    # Padding acts as the identity transition, so beta at the session end is (1, 1).
    u00 = np.where(clicks & mask, 0.0, 1.0)
    u01 = np.where(mask, np.where(clicks, sat * a, inv * not_a), 0.0)
    u11 = np.where(mask, np.where(clicks, gamma * (1.0 - s) * a, gamma * not_a), 1.0)
    al0 = np.empty((n + 1, p))
    al1 = np.empty((n + 1, p))
    be0 = np.empty((n + 1, p))
    be1 = np.empty((n + 1, p))
    al0[0], al1[0], be0[n], be1[n] = 0.0, 1.0, 1.0, 1.0
    for i in range(n):
        np.multiply(al0[i], u00[i], out=al0[i + 1])
        al0[i + 1] += al1[i] * u01[i]
        np.multiply(al1[i], u11[i], out=al1[i + 1])
        j = n - 1 - i
        np.multiply(be0[j + 1], u00[j], out=be0[j])
        np.multiply(be0[j + 1], u01[j], out=be1[j])
        be1[j] += be1[j + 1] * u11[j]
    ab0 = al0 * be0
    phi = ab0 / (ab0 + al1 * be1)
    est_a = np.where(clicks, 1.0, a * phi[:n])
    est_s = np.where(clicks, phi[1:] * s / sat, 0.0)
    return est_a, est_s


class _EmLoop:
    """E-step of :func:`_estep_t` specialised for repeated calls on the same
    sessions: click/padding structure is fixed, buffers are reused, and only
    the masked estimates the M-step needs are returned."""

    def __init__(self, clicks: np.ndarray, mask: np.ndarray, gamma: float):
        n, p = clicks.shape
        self.n, self.gamma, self.inv = n, gamma, 1.0 - gamma
        self.clicks, self.mask, self.pad = clicks, mask, ~mask
        self.u00 = np.where(clicks & mask, 0.0, 1.0)
        self.al0, self.al1 = np.empty((n + 1, p)), np.empty((n + 1, p))
        self.be0, self.be1 = np.empty((n + 1, p)), np.empty((n + 1, p))
        self.al0[0], self.al1[0], self.be0[n], self.be1[n] = 0.0, 1.0, 1.0, 1.0

    def step(self, a: np.ndarray, s: np.ndarray, c_rows: np.ndarray):
        n, g, inv, clk = self.n, self.gamma, self.inv, self.clicks
        sat = self.inv + g * s                       # s + (1 - g)(1 - s)
        not_a = 1.0 - a
        u01 = np.where(clk, sat * a, inv * not_a)
        u11 = np.where(clk, (1.0 - s) * a, not_a)
        u11 *= g
        np.putmask(u01, self.pad, 0.0)
        np.putmask(u11, self.pad, 1.0)
        u00, al0, al1, be0, be1 = self.u00, self.al0, self.al1, self.be0, self.be1
        for i in range(n):
            np.multiply(al0[i], u00[i], out=al0[i + 1])
            al0[i + 1] += al1[i] * u01[i]
            np.multiply(al1[i], u11[i], out=al1[i + 1])
            j = n - 1 - i
            np.multiply(be0[j + 1], u00[j], out=be0[j])
            np.multiply(be0[j + 1], u01[j], out=be1[j])
            be1[j] += be1[j + 1] * u11[j]
        ab0 = al0 * be0
        phi = ab0 / (ab0 + al1 * be1)
        m = self.mask
        ea = np.where(clk, 1.0, a * phi[:n])[m]
        es = (phi[1:] * s / sat)[m][c_rows]
        return ea, es


def _pad(seqs: Sequence, n: int, fill, dtype, mask: np.ndarray | None = None):
    """Left-aligned (P, n) matrix of variable-length sequences."""
    out = np.full((len(seqs), n), fill, dtype=dtype)
    if len(seqs):
        if mask is None:
            lengths = np.fromiter((len(q) for q in seqs), dtype=np.int64, count=len(seqs))
            mask = np.arange(n)[None, :] < lengths[:, None]
        out[mask] = np.concatenate([np.asarray(q, dtype=dtype) for q in seqs])
    return out


def _train_local(pages: Sequence, clicks: Sequence, weights: np.ndarray, iterations: int,
                 default_rel: float, gamma: float, group_ids: np.ndarray | None = None):
    """EM for one or many query groups at once (sessions as sequences)."""
    lengths = np.fromiter((len(p) for p in pages), dtype=np.int64, count=len(pages))
    flat_pages = np.concatenate([np.asarray(p) for p in pages])
    flat_clicks = np.concatenate([np.asarray(c, dtype=bool) for c in clicks])
    return _train_flat(lengths, flat_pages, flat_clicks, weights, iterations, default_rel, gamma, group_ids)


def _train_flat(lengths: np.ndarray, flat_pages: np.ndarray, flat_clicks: np.ndarray, weights: np.ndarray,
                iterations: int, default_rel: float, gamma: float, group_ids: np.ndarray | None = None):
    """EM for one or many query groups at once.  Parameters are indexed by
    (group, page), so sessions of different groups never share a page; every
    iteration is a handful of vectorised numpy passes over all sessions.
    Sessions are given flat: ``lengths`` per session, then their pages and
    clicks concatenated in session order."""
    n = int(lengths.max())
    mask = np.arange(n)[None, :] < lengths[:, None]
    gids = np.zeros(len(lengths), dtype=np.int64) if group_ids is None else np.asarray(group_ids)
    flat_groups = np.repeat(gids, lengths)
    if np.issubdtype(flat_pages.dtype, np.integer) and len(flat_pages) and flat_pages.min() >= 0 \
            and int(flat_pages.max()) < (1 << 40) and int(flat_groups.max(initial=0)) < (1 << 22):
        # Integer pages: one int64 (group, page) key is far cheaper to factorize.
        combined = (flat_groups.astype(np.int64) << 40) | flat_pages.astype(np.int64)
        codes, keys = pd.factorize(combined)
        uniq = pd.MultiIndex.from_arrays([keys >> 40, keys & ((1 << 40) - 1)])
    else:
        codes, uniq = pd.factorize(pd.MultiIndex.from_arrays([flat_groups, flat_pages]))
    n_params = len(uniq)
    # Position-major layout (N, P); masked index/weight vectors fixed once.
    idx = np.zeros((n, len(lengths)), dtype=np.int64)
    mask_t = np.ascontiguousarray(mask.T)
    idx.T[mask] = codes
    cl = np.zeros((len(lengths), n), dtype=bool)
    cl[mask] = flat_clicks
    cl_t = np.ascontiguousarray(cl.T)
    w_t = np.broadcast_to(weights[None, :], idx.shape)
    m_idx, m_w = idx[mask_t], w_t[mask_t]
    c_sel = cl_t[mask_t]
    c_idx, c_w = m_idx[c_sel], m_w[c_sel]
    a = np.full(n_params, default_rel)
    s = np.full(n_params, default_rel)
    em = _EmLoop(cl_t, mask_t, gamma)
    c_rows = cl_t[mask_t]
    for _ in range(iterations):
        ea_m, es_c = em.step(a[idx], s[idx], c_rows)
        wa = m_w * ea_m
        a1 = 1.0 + np.bincount(m_idx, wa, n_params)
        a0 = 1.0 + np.bincount(m_idx, m_w - wa, n_params)
        ws = c_w * es_c
        s1 = 1.0 + np.bincount(c_idx, ws, n_params)
        s0 = 1.0 + np.bincount(c_idx, c_w - ws, n_params)
        a, s = a1 / (a1 + a0), s1 / (s1 + s0)
    return uniq.get_level_values(0).to_numpy(), uniq.get_level_values(1).to_numpy(), a, s


def patterns(sessions: DataFrame, group_cols: Sequence[str] = GROUP, page_type: str = "bigint") -> DataFrame:
    """Collapse sessions with identical (pages, clicks) into one weighted row.

    Input rows carry ``hits`` array<struct<..., hit_page_id, clicked>> already
    truncated (see :func:`rankwright.operators.clicks.eligible_sessions`)."""
    return (sessions.select(*group_cols,
                            F.col("hits.hit_page_id").cast(f"array<{page_type}>").alias("pages"),
                            F.col("hits.clicked").alias("clicks"))
            .groupBy(*group_cols, "pages", "clicks").agg(F.count(F.lit(1)).alias("weight")))


def _local_fn(group_cols, iterations, default_rel, gamma):
    """Per bucket: rows are (group..., _pid, _pos, hit_page_id, clicked, weight),
    one per position of each weighted session pattern."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_pid", "_pos"], kind="stable")
        pid = pdf["_pid"].to_numpy()
        starts = np.flatnonzero(np.r_[True, pid[1:] != pid[:-1]])
        lengths = np.diff(np.r_[starts, len(pid)])
        keys = pdf[list(group_cols)].iloc[starts].reset_index(drop=True)
        gid, _ = pd.factorize(pd.MultiIndex.from_frame(keys))
        g_of, pages, a, s = _train_flat(lengths, pdf["hit_page_id"].to_numpy(), pdf["clicked"].to_numpy(bool),
                                        pdf["weight"].to_numpy(dtype=float)[starts], iterations,
                                        default_rel, gamma, gid)
        first = pd.Series(np.arange(len(keys))).groupby(gid).first()
        out = keys.iloc[first.loc[g_of].to_numpy()].reset_index(drop=True)
        out["hit_page_id"] = pages
        out["a"], out["s"] = a, s
        return out[[*group_cols, "hit_page_id", "a", "s"]]
    return fit


def _estep_fn(group_cols, gamma):
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            pages = list(pdf["pages"])
            n = max(len(p) for p in pages)
            lengths = np.array([len(p) for p in pages])
            mask = np.arange(n)[None, :] < lengths[:, None]
            a = _pad(list(pdf["pa"]), n, 0.5, float, mask)
            s = _pad(list(pdf["ps"]), n, 0.5, float, mask)
            cl = _pad(list(pdf["clicks"]), n, False, bool, mask) & mask
            ea, es = estep(a, s, cl, mask, gamma)
            w = pdf["weight"].to_numpy(dtype=float)[:, None]
            rows, pos = np.nonzero(mask)
            out = pd.DataFrame({c: pdf[c].to_numpy()[rows] for c in group_cols})
            out["hit_page_id"] = _pad(pages, n, None, object, mask)[rows, pos]
            out["a1"] = (w * ea)[rows, pos]
            out["a0"] = (w * (1.0 - ea))[rows, pos]
            clicked = cl[rows, pos]
            out["s1"] = np.where(clicked, (w * es)[rows, pos], 0.0)
            out["s0"] = np.where(clicked, (w * (1.0 - es))[rows, pos], 0.0)
            yield out
    return run


def _train_distributed(pats: DataFrame, group_cols, iterations, default_rel, gamma,
                       page_type: str = "bigint", checkpoint_every: int = 5) -> DataFrame:
    g = list(group_cols)
    pats = cut_lineage(pats.withColumn("pid", F.monotonically_increasing_id()))
    positions = pats.select(*g, "pid", F.posexplode("pages").alias("pos", "hit_page_id"))
    params = (positions.select(*g, "hit_page_id").distinct()
              .withColumn("a", F.lit(default_rel)).withColumn("s", F.lit(default_rel)))
    est_schema = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in pats.schema if f.name in g]
        + [f"hit_page_id {page_type}", "a1 double", "a0 double", "s1 double", "s0 double"])
    for it in range(iterations):
        per_pos = (positions.join(params, [*g, "hit_page_id"])
                   .groupBy(*g, "pid")
                   .agg(F.sort_array(F.collect_list(F.struct("pos", "a", "s"))).alias("_p")))
        rows = (pats.join(per_pos, [*g, "pid"])
                .select(*g, "pages", "clicks", "weight",
                        F.col("_p.a").alias("pa"), F.col("_p.s").alias("ps")))
        est = rows.mapInPandas(_estep_fn(g, gamma), est_schema)
        sums = est.groupBy(*g, "hit_page_id").agg(*[F.sum(c).alias(c) for c in ("a1", "a0", "s1", "s0")])
        params = sums.select(*g, "hit_page_id",
                             ((1 + F.col("a1")) / (2 + F.col("a1") + F.col("a0"))).alias("a"),
                             ((1 + F.col("s1")) / (2 + F.col("s1") + F.col("s0"))).alias("s"))
        if (it + 1) % checkpoint_every == 0 or it == iterations - 1:
            params = cut_lineage(params)
    return params


def _pack(sent, batches):
    """Rows (_group, pages, clicks, weight) as arrays: a row a batch, its patterns by length, pages by their number among the
    (group, page) that were sent."""
    import pyarrow as pa
    import pyarrow.compute as pc
    groups, pages, keys = sent.value
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("pages")
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        group = pc.index_in(batch.column("_group"), value_set=groups).to_numpy(zero_copy_only=False).astype(np.int64)
        page = pc.index_in(lists.flatten(), value_set=pages).to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.searchsorted(keys, np.repeat(group, lengths) * len(pages) + page).astype(np.int32)
        clicks = pc.fill_null(batch.column("clicks").flatten(), False).to_numpy(zero_copy_only=False)
        order = np.argsort(lengths, kind="stable")
        starts, n = (np.cumsum(lengths) - lengths)[order], lengths[order]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
        weights = batch.column("weight").to_numpy(zero_copy_only=False).astype(float)[order]
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (n.astype(np.int32), number[at], clicks[at], weights)],
                                         ["lengths", "pages", "clicks", "weights"])


def _packed_sums(sent, gamma, batches):
    """(page, a1, a0, s1, s0) of a task's packed patterns."""
    import pyarrow as pa
    a, s = sent.value
    sums = np.zeros((4, len(a)))
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("lengths", "pages", "clicks", "weights")]):
            lengths, pages, clicks, weights = (np.frombuffer(x, kind) for x, kind in zip(row, (np.int32, np.int32, bool, float)))
            ends, done = np.searchsorted(lengths, np.unique(lengths), "right"), 0
            for end in ends.tolist():
                n = int(lengths[end - 1])
                for lo in range(end - int(np.sum(lengths == n)), end, STEP_PATTERNS):
                    hi = min(lo + STEP_PATTERNS, end)
                    size = (hi - lo) * n
                    idx = np.ascontiguousarray(pages[done:done + size].reshape(-1, n).T)
                    cl = np.ascontiguousarray(clicks[done:done + size].reshape(-1, n).T)
                    done += size
                    if not n:
                        continue
                    ea, es = _estep_t(a[idx], s[idx], cl, np.ones(cl.shape, bool), gamma)
                    w = np.broadcast_to(weights[lo:hi], cl.shape)
                    sums[0] += np.bincount(idx.ravel(), (w * ea).ravel(), len(a))
                    sums[1] += np.bincount(idx.ravel(), (w * (1.0 - ea)).ravel(), len(a))
                    sums[2] += np.bincount(idx[cl], (w * es)[cl], len(a))
                    sums[3] += np.bincount(idx[cl], (w * (1.0 - es))[cl], len(a))
    held = np.flatnonzero(sums.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64)), *[pa.array(x[held]) for x in sums]], ["page", "a1", "a0", "s1", "s0"])


def _train_sent(pats: DataFrame, pages: DataFrame, group_cols, iterations, default_rel, gamma) -> DataFrame:
    """EM of large groups whose parameters are sent to every task.  ``pages``: (_group, group..., hit_page_id), a row a
    parameter."""
    import pyarrow as pa
    import pyarrow.compute as pc
    spark, names = pats.sparkSession, ("a1", "a0", "s1", "s0")
    known = pages.toArrow()
    group, page = (pc.dictionary_encode(pa.concat_arrays(known[c].chunks), null_encoding="encode") for c in ("_group", "hit_page_id"))
    keys = group.indices.to_numpy().astype(np.int64) * len(page.dictionary) + page.indices.to_numpy()
    order = np.argsort(keys)
    known, n = known.take(pa.array(order)), len(keys)
    numbers = spark.sparkContext.broadcast((group.dictionary, page.dictionary, keys[order]))
    packed = cut_lineage(pats.select("_group", "pages", "clicks", "weight").mapInArrow(partial(_pack, numbers), PACKED))
    a, s = np.full(n, default_rel), np.full(n, default_rel)
    for _ in range(iterations):
        sent = spark.sparkContext.broadcast((a, s))
        found = packed.mapInArrow(partial(_packed_sums, sent, gamma), "page bigint, " + ", ".join(f"{c} double" for c in names)) \
            .groupBy("page").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
        sums = np.zeros((4, n))
        for i, c in enumerate(names):
            sums[i, found["page"].to_numpy()] = found[c].to_numpy()
        a, s = (1 + sums[0]) / (2 + sums[0] + sums[1]), (1 + sums[2]) / (2 + sums[2] + sums[3])
        sent.destroy()
    retire(packed)
    fields = pages.drop("_group").schema
    return spark.createDataFrame(known.drop_columns(["_group"]).append_column("a", pa.array(a)).append_column("s", pa.array(s)),
                                 fields.add("a", "double").add("s", "double"))


def click_model(sessions: DataFrame, iterations: int = 40, default_rel: float = 0.5, gamma: float = 0.9,
                group_cols: Sequence[str] = GROUP, max_patterns_per_task: int = 200_000,
                page_type: str = "bigint", patterns_per_bucket: int = 50_000) -> DataFrame:
    """M3: relevance per (group, hit_page_id) from eligible sessions.

    Returns (group..., hit_page_id bigint, relevance double)."""
    from ..session import ship_package
    ship_package(sessions.sparkSession)
    g = list(group_cols)
    pats = patterns(sessions, g, page_type)
    # Patterns are read by the size check and by both paths: write them once
    # (reliable checkpoint), which also cuts the upstream plan, so the many
    # small plans below do not re-analyse the whole sessions lineage.
    pats = cut_lineage(pats.dropna(subset=g))
    # Groups that fill half a bucket are few (their patterns add up), so they are sent and no pattern is shuffled.
    heavy = pats.groupBy(*g).agg(F.count(F.lit(1)).alias("_n_patterns")) \
        .where((F.col("_n_patterns") * 2 > patterns_per_bucket) | (F.col("_n_patterns") > max_patterns_per_task))
    tagged = pats.join(F.broadcast(heavy), g, "left")
    is_big = F.coalesce(F.col("_n_patterns") > max_patterns_per_task, F.lit(False))
    small = tagged.where(~is_big).withColumn("_own", F.coalesce(F.col("_n_patterns") * 2 > patterns_per_bucket, F.lit(False))).drop("_n_patterns")
    big = tagged.where(is_big).drop("_n_patterns")
    key_types = {f.name: f.dataType.simpleString() for f in pats.schema}
    schema = ", ".join([f"{c} {key_types[c]}" for c in g] + [f"hit_page_id {page_type}", "a double", "s double"])
    # Many small groups share one pandas call: groups are hashed into buckets
    # sized so a bucket holds about ``patterns_per_bucket`` patterns.  A group that
    # fills half a bucket has its own call, so large groups never meet in one.
    total = pats.count()
    parallelism = sessions.sparkSession.sparkContext.defaultParallelism
    buckets = max(parallelism, -(-int(total) // patterns_per_bucket))
    flat = (small.withColumn("_bucket", F.when(~F.col("_own"), F.pmod(F.xxhash64(*g), F.lit(buckets))))
            .withColumn("_group", F.when(F.col("_own"), F.to_json(F.struct(*g))))
            .withColumn("_pid", F.monotonically_increasing_id())
            .select("_bucket", "_group", *g, "_pid", "weight",
                    F.posexplode(F.arrays_zip(F.col("pages").alias("p"), F.col("clicks").alias("c")))
                    .alias("_pos", "_pc"))
            .select("_bucket", "_group", *g, "_pid", "_pos", F.col("_pc.p").alias("hit_page_id"),
                    F.col("_pc.c").alias("clicked"), "weight"))
    local = flat.groupBy("_bucket", "_group").applyInPandas(_local_fn(g, iterations, default_rel, gamma), schema)
    out = local
    if big.limit(1).count() > 0:
        big = big.withColumn("_group", F.to_json(F.struct(*g)))
        pages = big.select("_group", *g, F.explode("pages").alias("hit_page_id")).distinct()
        if pages.count() <= SENT_PAGES:
            out = local.unionByName(_train_sent(big, pages, g, iterations, default_rel, gamma))
        else:
            out = local.unionByName(_train_distributed(big.drop("_group"), g, iterations, default_rel, gamma, page_type))
    return out.select(*g, "hit_page_id", (F.col("a") * F.col("s")).alias("relevance"))
