"""Counter-rate EMA as an exact scan over time ranges.

The recurrence is sequential per key, but what a stretch of time does to it is small: which
sample of a range is accepted last depends only on the last accepted time before the range, and
every accepted sample is an affine map of the ema.  So a key is cut into time ranges of about
equal numbers of rows (cuts from percentiles, so a burst gets ranges of its own), and

1. one aggregate finds each key's first sample and the first one after it that gives a rate;
2. each range tells which accepted sample it leaves for any state it may be entered with;
3. per key, these answers (a few rows a range) are followed from range to range;
4. each range replays its samples from the state it is entered with, as composed maps;
5. per key, the ranges' maps (one row each) give the ema at each range's start.

No task holds a whole key, and there is no loop of jobs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE_ROWS = 50_000


def affine_coefficients(dt: float, dc: float, alpha: float, first: bool) -> tuple[float, float]:
    """The map ``ema ← scale · ema + shift`` of an accepted sample, ``dt`` seconds and ``dc``
    counts after the one before."""
    if first:
        return 0.0, dc / dt
    decay = (1 - alpha) ** int(dt // 1)
    return (decay, dc / dt * (1 - decay)) if dc >= 0 else (1.25 - 0.25 * decay, 0.0)


def _ranges(df: DataFrame, ts: str) -> tuple:
    """Number of a row's time range as a column; the cuts are approximate percentiles."""
    n = max(1, -(-df.count() // RANGE_ROWS))
    marks = [i / n for i in range(1, n)]
    cuts = (df.agg(F.percentile_approx(F.col(ts).cast("double"), F.array(*map(F.lit, marks)), F.lit(max(10000, 20 * n))))
            .first()[0] if marks else []) or []
    edges = np.array(sorted(set(cuts)), dtype=float)

    @F.pandas_udf("int")
    def number(t: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, t.to_numpy(dtype=float), side="right").astype(np.int32))

    return number(F.col(ts).cast("double"))


def _leaves(pdf: pd.DataFrame) -> pd.DataFrame:
    """For a range: up to which entry time (of its first accepted sample) it leaves which sample."""
    t, c = pdf["_t"].to_numpy(), pdf["_c"].to_numpy()
    successor = np.searchsorted(t, t + 1, side="left")
    leaves = np.arange(len(t))
    for i in range(len(t) - 1, -1, -1):
        if successor[i] < len(t):
            leaves[i] = leaves[successor[i]]
    # entered from before: the first accepted sample lies in the first second, or is the next after it
    last = min(len(t) - 1, int(np.searchsorted(t, t[0] + 1, side="left")))
    entry = np.arange(last + 1)
    entry = entry[np.append(t[entry][1:] != t[entry][:-1], True) | (entry == last)]
    first_of_time = np.searchsorted(t, t[entry], side="left")
    way_out = leaves[first_of_time]
    keep = np.append(way_out[1:] != way_out[:-1], True)
    return pd.DataFrame({"_upto": t[entry][keep], "_lt": t[way_out][keep], "_lc": c[way_out][keep]})


def counter_rate_ema_scan(df: DataFrame, key: str, ts: str, count: str, order: str,
                          alpha: float = 0.1, max_sec_valid: float = 660) -> DataFrame:
    """Rows of ``df`` with ``accepted``, ``ema`` and ``valid``."""
    cols = list(df.columns)
    kind = df.schema[key].dataType.simpleString()
    rows = df.withColumn("_g", _ranges(df, ts)).withColumn("_t", F.col(ts).cast("double")) \
        .withColumn("_c", F.col(count).cast("double"))
    place = F.struct("_t", order, "_c")
    primer = rows.groupBy(key).agg(F.min(place).alias("_p"))
    after = rows.join(primer, key).where((F.col("_t") >= F.col("_p._t") + 1) & (F.col("_c") >= F.col("_p._c")))
    first = after.groupBy(key).agg(F.min(place).alias("_f"))
    start = primer.join(first, key, "left").select(
        key, F.col("_p._t").alias("_pt"), F.col(f"_p.{order}").alias("_po"), F.col("_p._c").alias("_pc"),
        F.col("_f._t").alias("_ft"), F.col(f"_f.{order}").alias("_fo"))
    rows = rows.join(start, key)
    schema = df.schema

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_t", order])
        # before the first rate nothing is accepted but the primer: the chain starts at the first rate
        at = pdf[(pdf["_t"] > pdf["_ft"]) | ((pdf["_t"] == pdf["_ft"]) & (pdf[order] >= pdf["_fo"]))]
        out = _leaves(at) if len(at) else pd.DataFrame({"_upto": [], "_lt": [], "_lc": []})
        return out.assign(**{key: pdf[key].iloc[0], "_g": pdf["_g"].iloc[0], "_ft": pdf["_ft"].iloc[0]})[
            [key, "_g", "_ft", "_upto", "_lt", "_lc"]]

    left = rows.where(F.col("_ft").isNotNull()).groupBy(key, "_g").applyInPandas(
        leave, f"`{key}` {kind}, _g int, _ft double, _upto double, _lt double, _lc double")

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        last, out = None, []
        for g, own in pdf.sort_values(["_g", "_upto"]).groupby("_g"):
            out.append((g, *(last or (np.nan, np.nan))))
            # the first rate itself enters the chain; later ranges are entered a second after the last
            need = own["_ft"].iloc[0] if last is None else last[0] + 1
            at = int(np.searchsorted(own["_upto"].to_numpy(), need, side="left"))
            if at < len(own):
                last = (own["_lt"].iloc[at], own["_lc"].iloc[at])
        return pd.DataFrame(out, columns=["_g", "_et", "_ec"]).assign(**{key: pdf[key].iloc[0]})[[key, "_g", "_et", "_ec"]]

    entries = left.groupBy(key).applyInPandas(enter, f"`{key}` {kind}, _g int, _et double, _ec double")
    entered = rows.join(entries, [key, "_g"], "left")
    result = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] +
                       ["_g int", "accepted boolean", "_since double", "_P double", "_Q double", "_i int"])

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_t", order])
        t, c, o = pdf["_t"].to_numpy(), pdf["_c"].to_numpy(), pdf[order].to_numpy()
        pt, pc, po, ft, fo = (pdf[x].iloc[0] for x in ("_pt", "_pc", "_po", "_ft", "_fo"))
        last = (pdf["_et"].iloc[0], pdf["_ec"].iloc[0])
        accepted = (t == pt) & (o == po)
        since, scale, shift = np.full(len(t), pt), np.ones(len(t)), np.zeros(len(t))
        if np.isnan(ft):
            scale[:] = np.nan
            return _replayed(pdf, accepted, since, scale, shift)
        started = not np.isnan(last[0])
        if not started:  # the first rate, if it lies here, is the first accepted sample after the primer
            after = (t > ft) | ((t == ft) & (o >= fo))
            at = int(after.argmax()) if after.any() else len(t)
            scale[:at] = np.nan
            last = (pt, pc)
        else:
            since[:] = last[0]
            at = int(np.searchsorted(t, last[0] + 1, side="left"))
        p, q = 1.0, 0.0
        while at < len(t):
            a, b = affine_coefficients(t[at] - last[0], c[at] - last[1], alpha, not started)
            p, q, started = a * p, a * q + b, True
            last = (t[at], c[at])
            accepted[at] = True
            nxt = max(at + 1, int(np.searchsorted(t, t[at] + 1, side="left")))
            since[at:nxt], scale[at:nxt], shift[at:nxt] = t[at], p, q
            at = nxt
        return _replayed(pdf, accepted, since, scale, shift)

    def _replayed(pdf, accepted, since, scale, shift):
        return pdf[cols + ["_g"]].assign(accepted=accepted, _since=since, _P=scale, _Q=shift, _i=np.arange(len(pdf)))

    composed = entered.groupBy(key, "_g").applyInPandas(replay, result)
    totals = composed.groupBy(key, "_g").agg(F.max_by(F.struct("_P", "_Q"), "_i").alias("_m")) \
        .select(key, "_g", F.col("_m._P").alias("_P"), F.col("_m._Q").alias("_Q"))

    def values(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_g")
        v, out = 0.0, []
        for p, q in zip(pdf["_P"], pdf["_Q"]):
            out.append(v)
            v = v if np.isnan(p) else p * v + q
        return pdf[[key, "_g"]].assign(_v=out)

    begin = totals.groupBy(key).applyInPandas(values, f"`{key}` {kind}, _g int, _v double")
    ema = F.when(~F.isnan("_P"), F.col("_P") * F.col("_v") + F.col("_Q"))
    out = composed.join(begin, [key, "_g"]).withColumn("ema", ema)
    return out.select(*cols, "accepted", "ema", (F.col("ema").isNotNull() & (
        F.col(ts).cast("double") < F.col("_since") + max_sec_valid)).alias("valid"))
