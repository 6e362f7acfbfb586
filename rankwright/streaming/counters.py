"""Counter-rate EMA and load gate.

Rules per key, over samples (time s, cumulative count) in time order:
* the first sample only primes the state;
* a sample less than 1 s after the last accepted one is ignored;
* rate = Δcount / Δt; a negative Δcount (counter reset) uses 1.25 × ema,
  and is ignored while the ema is unset;
* the first rate initialises the ema; afterwards the ema moves one step per
  whole second: ema ← rate + (ema − rate)·(1 − α)^⌊Δt⌋;
* the ema is valid until ``max_sec_valid`` seconds after the last accepted
  sample.

Every accepted sample after the first is an affine map of the ema (``ema_scan.affine``).  The
batch form composes the maps in an exact parallel scan; the streaming form applies them one
accepted sample after the other to its O(1) state (``applyInPandasWithState``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.window import Window

from ..session import cut_lineage
from .ema_scan import affine_coefficients, counter_rate_ema_scan

NO_VALUE = float("nan")


def follow(t: np.ndarray, c: np.ndarray, alpha: float, last: tuple[float, float, float] | None):
    """Samples of one key in time order after the accepted sample ``last`` (time, count, ema).

    Gives the accepted places, the (time, ema) that holds at each sample, and the new ``last``."""
    accepted = np.zeros(len(t), dtype=bool)
    since, value = np.full(len(t), NO_VALUE), np.full(len(t), NO_VALUE)
    at = 0
    if last is None:
        if not len(t):
            return accepted, since, value, None
        last, accepted[0] = (t[0], c[0], NO_VALUE), True
    while True:
        # the next sample that counts; before the first rate the counter must not have dropped
        then = max(at, int(np.searchsorted(t, last[0] + 1, side="left")))
        if math.isnan(last[2]):
            while then < len(t) and c[then] < last[1]:
                then += 1
        since[at:then], value[at:then] = last[0], last[2]
        if then >= len(t):
            return accepted, since, value, last
        scale, shift = affine_coefficients(t[then] - last[0], c[then] - last[1], alpha, math.isnan(last[2]))
        last = (t[then], c[then], shift if math.isnan(last[2]) else scale * last[2] + shift)
        accepted[then], at = True, then


def running_count(df: DataFrame, key: str, ts: str, order: str, buckets: int = 1024) -> DataFrame:
    """Cumulative number of rows per key in (ts, order) order, as ``count``.

    A distributed prefix count: rows are cut into ``buckets`` time buckets
    over the global range; bucket totals per key (a small table) give each
    bucket's offset, and the rank inside a (key, bucket) finishes the count —
    no task holds a whole key."""
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()  # one row
    width = ((hi - lo) / buckets) if hi is not None and hi > lo else 1.0
    b = F.least(F.floor((F.col(ts) - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1))
    tagged = df.withColumn("_b", b)
    totals = tagged.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    wo = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_bn").over(wo), F.lit(0))).drop("_bn")
    rank = F.row_number().over(Window.partitionBy(key, "_b").orderBy(ts, order))
    return (tagged.join(offsets, [key, "_b"])
            .withColumn("count", (F.col("_off") + rank).cast("double"))
            .drop("_b", "_off"))


def counter_rate_ema(df: DataFrame, key: str, ts: str, count: str, order: str | None = None,
                     alpha: float = 0.1, max_sec_valid: float = 660) -> DataFrame:
    """T6 batch replay: per sample (…, accepted, ema, valid); ``ts`` in seconds.

    The exact parallel scan of :mod:`rankwright.streaming.ema_scan` for keys of any size: no
    task holds a whole key and the job depth grows with log(n).  Samples of equal time are
    taken by ``order``; without one by their place in the input, fixed by a checkpoint."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    if order is not None:
        return counter_rate_ema_scan(df, key, ts, count, order, alpha, max_sec_valid)
    placed = cut_lineage(df.withColumn("_order", F.monotonically_increasing_id()))
    return counter_rate_ema_scan(placed, key, ts, count, "_order", alpha, max_sec_valid).drop("_order")


def load_gate(ema_rows: DataFrame, key: str, ts: str, threshold: float, now,
              max_sec_valid: float = 660) -> DataFrame:
    """Per key, allowed = the latest ema is valid at ``now`` and below
    ``threshold``; a key without any ema is not allowed."""
    latest = (ema_rows.where(F.col("accepted"))
              .groupBy(key).agg(F.max_by(F.struct(ts, "ema"), F.col(ts)).alias("_l")))
    now_c = F.lit(now) if not hasattr(now, "alias") else now
    return latest.select(
        key, F.col("_l.ema").alias("ema"),
        (F.col("_l.ema").isNotNull() & ~F.isnan("_l.ema") & (now_c < F.col(f"_l.{ts}") + max_sec_valid)
         & (F.col("_l.ema") < threshold)).alias("allowed"))


def counter_ema_stream(stream: DataFrame, key: str, ts: str, count: str, alpha: float = 0.1,
                       max_sec_valid: float = 660) -> DataFrame:
    """T6 streaming: stateful per-key EMA with O(1) state (prev time, prev
    count, value); emits one row per sample like the batch form."""
    out_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema] +
                           ["accepted boolean", "ema double", "valid boolean"])

    def step(k, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values(ts, kind="mergesort")
        t, c = batch[ts].to_numpy(dtype=float), batch[count].to_numpy(dtype=float)
        accepted, since, value, last = follow(t, c, alpha, state.get if state.exists else None)
        state.update(last)
        yield batch.assign(accepted=accepted, ema=value, valid=~np.isnan(value) & (t < since + max_sec_valid))

    return stream.groupBy(key).applyInPandasWithState(
        step, out_schema, "time double, count double, ema double", "append", GroupStateTimeout.NoTimeout)
