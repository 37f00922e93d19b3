"""Event-effect estimation.

A loop over events becomes one cogroup of series and events by time span, in
which all windows are answered by range queries (``pre_post``), and aggregates
per action. Bootstraps and Welch tests run on the per-event table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import stats as S
from .asof import asof_join
from ..functions.moments import window_moments
from ..functions.ranges import FirstBelow, RangeRanks
from ..session import cut_lineage
from .rangejoin import ROW_T, ROW_TIE, control_centre, event_windows
from .rangejoin import window_moments as edge_moments
from .window import finite


def _window_stats(win: DataFrame, key: str, value: str, min_pts: int, *, carry: Sequence[str] = (),
                  with_p95: bool = True, smooth: int | None = None) -> DataFrame:
    """Per event: pre/post means, counts (and p95, restoration time).

    Every step is clustered on the event key (whole-partition window for the
    pre mean, per (event, role) running window for the trailing mean, then
    the grouped aggregate), so the joined window rows are shuffled once.
    """
    pre = F.col("role") == "pre"
    post = F.col("role") == "post"
    x = win
    aggs = [F.avg(F.when(pre, F.col(value))).alias("pre_mean"),
            F.avg(F.when(post, F.col(value))).alias("post_mean"),
            F.count(F.when(pre, F.lit(1))).alias("pre_n"),
            F.count(F.when(post, F.lit(1))).alias("post_n"),
            *[F.first(c).alias(c) for c in carry]]
    ev = Window.partitionBy(key)       # every window shares one hash exchange on the event
    if with_p95:
        # exact interpolated p95 from the value rank inside each role; rows are
        # ordered (role, value) per event ('post' sorts before 'pre')
        x = (x.withColumn("__pn", F.count(F.when(post, F.lit(1))).over(ev))
              .withColumn("__qn", F.count(F.when(pre, F.lit(1))).over(ev))
              .withColumn("__rk", F.row_number().over(ev.orderBy("role", value)) - 1))
        vr = F.when(post, F.col("__rk")).otherwise(F.col("__rk") - F.col("__pn"))
        vn = F.when(post, F.col("__pn")).otherwise(F.col("__qn"))
        h = (vn - 1) * F.lit(0.95)
        at_lo = vr == F.floor(h)
        at_hi = vr == F.ceil(h)
        frac = h - F.floor(h)
        for role, cond in (("pre", pre), ("post", post)):
            aggs += [F.max(F.when(cond & at_lo, F.col(value))).alias(f"__{role}_lo"),
                     F.max(F.when(cond & at_hi, F.col(value))).alias(f"__{role}_hi"),
                     F.max(F.when(cond, frac)).alias(f"__{role}_frac")]
    if smooth:
        x = x.withColumn("__pre_mean", F.avg(F.when(pre, F.col(value))).over(ev))
        # post rows first in (role, t, tie) order: their running numbers and
        # trailing means only ever see post rows once __rn >= smooth
        wp = ev.orderBy("role", ROW_T, ROW_TIE)
        x = (x.withColumn("__rn", F.row_number().over(wp))
              .withColumn("__m", F.avg(value).over(wp.rowsBetween(-(smooth - 1), 0))))
        ok = post & (F.col("__rn") >= smooth) & (F.col("__m") <= F.col("__pre_mean"))
        aggs += [F.min(F.when(ok, F.col(ROW_T))).alias("__first_ok"),
                 F.max(F.when(post, F.col(ROW_T))).alias("__last")]
    g = x.groupBy(key).agg(*aggs).where((F.col("pre_n") >= min_pts) & (F.col("post_n") >= min_pts))
    g = g.withColumn("delta_mean", F.col("post_mean") - F.col("pre_mean"))
    if with_p95:
        for role in ("pre", "post"):
            lo, hi, fr = (F.col(f"__{role}_{k}") for k in ("lo", "hi", "frac"))
            g = g.withColumn(f"{role}_p95", lo + fr * (hi - lo))
        g = g.withColumn("delta_p95", F.col("post_p95") - F.col("pre_p95")).drop(
            *[f"__{r}_{k}" for r in ("pre", "post") for k in ("lo", "hi", "frac")])
    return g


#: Series rows of three half-widths up to which a task holds them; denser spans are joined row by row.
SPAN_ROWS = 2_000_000


def _effects_of_span(t: np.ndarray, v: np.ndarray, centre: np.ndarray, half_width: int, smooth: int) -> dict[str, np.ndarray]:
    """Window figures of every centre over a series sorted by (t, tie); missing
    values are NaN. No window's rows are gone through: means come from merged
    moments, quantiles from a wavelet matrix, the restoration from the first
    small trailing mean, which is computed once per series row."""
    lo, mid, hi = (np.searchsorted(t, x, side) for x, side in (
        (centre - half_width, "left"), (centre, "left"), (centre + half_width, "right")))
    after = np.minimum(mid + 1, hi)  # the first row at or after the centre is left out
    fine = np.isfinite(v)
    upto = np.concatenate([[0], np.cumsum(fine)])  # ranges of rows as ranges of values
    ranks = RangeRanks(v[fine])
    out = {"pre_n": mid - lo, "post_n": hi - after}
    for role, a, b in (("pre", lo, mid), ("post", after, hi)):
        n, mean, _ = window_moments(v, a, b)
        out[f"{role}_mean"] = np.where(n > 0, mean, np.nan)
        out[f"{role}_p95"] = ranks.quantile(upto[a], upto[b], 0.95)
    rows = np.arange(len(t))
    n, trailing, _ = window_moments(v, np.maximum(rows - smooth + 1, 0), rows + 1)
    trailing = np.where((n > 0) & (rows >= smooth - 1), trailing, np.inf)
    first = FirstBelow(trailing).find(np.minimum(after + smooth - 1, hi), hi, out["pre_mean"])
    at = np.where(first < hi, first, hi - 1)
    out["restoration_time"] = np.where(out["post_n"] >= smooth, (t[np.maximum(at, 0)] if len(t) else 0) - centre, np.nan)
    return out


def pre_post(series: DataFrame, events: DataFrame, *, t_col: str, tie_col: str, value_col: str,
             event_key: str, event_t: str, half_width: int, min_pts: int = 5, smooth: int = 5,
             attrs: Sequence[str] = (), span_rows: int | None = None) -> DataFrame:
    """K1 (+ W6): per treated event pre/post mean, p95, counts, deltas and
    restoration time (first post tick whose ``smooth``-point trailing mean is
    <= the pre mean, else the last post tick; minus the event tick).

    Time is cut into spans of the half-width; a series row visits three of them,
    an event lies in one, so O(series + events) rows are shuffled and a span's
    events are answered together (``_effects_of_span``). Spans denser than
    ``span_rows``, found by one count, go through the row-by-row window join
    instead, which spills: results are the same."""
    w = int(half_width)
    limit = int(span_rows or SPAN_ROWS)
    span = lambda c: F.expr(f"({c} - pmod({c}, {w}L)) div {w}L")
    s = series.select(F.col(t_col).cast("long").alias("row_t"), F.col(tie_col).alias("row_tie"), finite(value_col).alias("row_v"))
    e = events.select(event_key, F.col(event_t).cast("long").alias("event_tick"), *attrs).withColumn("span", span("event_tick"))
    visits = s.withColumn("own", span("row_t")).select("*", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)).alias("span"))
    dense = cut_lineage(visits.groupBy("span").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("span"))
    crowded = dense.limit(1).count() > 0
    near = e.join(dense, "span", "left_anti") if crowded else e
    near_visits = visits.join(dense, "span", "left_anti") if crowded else visits
    figures = ["pre_mean", "post_mean", "pre_p95", "post_p95", "pre_n", "post_n", "restoration_time"]
    kinds = {c: "long" if c.endswith("_n") else "double" for c in figures}
    shape = T.StructType([*e.drop("span").schema.fields, *T.StructType.fromDDL(", ".join(f"{c} {k}" for c, k in kinds.items())).fields])

    def answer(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row_t", "row_tie"], ignore_index=True)
        got = _effects_of_span(rows["row_t"].to_numpy(dtype=np.int64), rows["row_v"].to_numpy(dtype=np.float64),
                               centres["event_tick"].to_numpy(dtype=np.int64), w, smooth)
        return centres.drop(columns="span").reset_index(drop=True).assign(**got)[shape.names]

    out = near_visits.select("span", "row_t", "row_tie", "row_v").groupBy("span").cogroup(near.groupBy("span")).applyInPandas(answer, shape)
    out = out.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if kinds.get(c) == "double" else F.col(c) for c in shape.names])
    out = out.where((F.col("pre_n") >= min_pts) & (F.col("post_n") >= min_pts))
    out = out.select(event_key, *attrs, F.col("event_tick").alias(event_t), *figures[:6],
                     (F.col("post_mean") - F.col("pre_mean")).alias("delta_mean"), (F.col("post_p95") - F.col("pre_p95")).alias("delta_p95"),
                     "restoration_time")
    if not crowded:
        return out
    far = e.join(dense, "span", "left_semi").select(event_key, F.col("event_tick").alias(event_t), *attrs)
    return out.unionByName(_pre_post_rows(series, far, t_col=t_col, tie_col=tie_col, value_col=value_col, event_key=event_key, event_t=event_t,
                                          half_width=w, min_pts=min_pts, smooth=smooth, attrs=attrs).select(*out.columns))


def _pre_post_rows(series: DataFrame, events: DataFrame, *, t_col: str, tie_col: str, value_col: str, event_key: str, event_t: str,
                   half_width: int, min_pts: int, smooth: int, attrs: Sequence[str]) -> DataFrame:
    """``pre_post`` by one row per (event, row in its window): any density, as
    sorts spill, at a cost that grows with the rows in all windows."""
    ev = events.select(event_key, F.col(event_t).alias("__centre"), *attrs)
    win = event_windows(series, ev, t_col=t_col, tie_col=tie_col, value_cols=[value_col],
                        event_keys=[event_key], centre_col="__centre", half_width=half_width)
    out = _window_stats(win, event_key, value_col, min_pts, carry=["__centre", *attrs], smooth=smooth)
    rt = F.when(F.col("post_n") < smooth, F.lit(None)).otherwise(
        F.coalesce(F.col("__first_ok"), F.col("__last")) - F.col("__centre"))
    cols = [event_key, *attrs, F.col("__centre").alias(event_t), "pre_mean", "post_mean", "pre_p95", "post_p95",
            "pre_n", "post_n", "delta_mean", "delta_p95", rt.cast("double").alias("restoration_time")]
    return out.select(*cols)


def did_deltas(series: DataFrame, events: DataFrame, *, t_col: str, tie_col: str, value_col: str,
               event_key: str, event_t: str, group_col: str, half_width: int, min_pts: int = 5,
               shift: int = 5) -> DataFrame:
    """K2 inputs: per treated event the treated delta (arm 'treated') and, when
    its shifted control window qualifies, the control delta (arm 'control').

    DiD needs only window means and counts, so both windows of every event
    come from one ``window_moments`` pass (running totals + edge lookups): no
    window rows are materialised. A control counts only for events whose
    treated window qualifies (the reference skips the control otherwise)."""
    t_min, t_max = series.agg(F.min(t_col), F.max(t_col)).first()
    ev = events.select(event_key, group_col, F.col(event_t).cast("long").alias("__centre"))
    centres = (ev.select(event_key, F.lit("treated").alias("arm"), F.col("__centre").alias("__cc"))
               .unionByName(ev.select(event_key, F.lit("control").alias("arm"), control_centre(
                   F.col("__centre"), half_width, int(t_min), int(t_max), shift).alias("__cc"))))
    m = edge_moments(series, centres, t_col=t_col, tie_col=tie_col, value_col=value_col,
                       centre_keys=[event_key, "arm"], centre_col="__cc", half_width=half_width)
    ok = (F.col("pre_n") >= min_pts) & (F.col("post_n") >= min_pts)
    d = m.where(ok).select(event_key, "arm", (F.col("post_sum") / F.col("post_n")
                                              - F.col("pre_sum") / F.col("pre_n")).alias("delta_mean"))
    treated_ok = d.where(F.col("arm") == "treated").select(event_key)
    d = d.join(treated_ok, event_key, "left_semi").join(ev.select(event_key, group_col), event_key)
    return d.select(event_key, group_col, "arm", "delta_mean")


def did_effects(deltas: DataFrame, *, event_key: str, group_col: str, n_boot: int = 2000,
                alpha: float = 0.05, seed: int = 42, min_n: int = 5) -> DataFrame:
    """K2: per group ATE = mean(treated) - mean(control), bootstrap CI, Welch p.

    The per-event deltas (one row per event) feed three aggregates; they are
    written once (reliable checkpoint) instead of re-running both window joins
    for each of them."""
    deltas = cut_lineage(deltas)
    wt = S.welch_test(deltas, [group_col], "arm", "delta_mean", "treated", "control")
    wt = wt.where((F.col("n_a") >= min_n) & (F.col("n_b") >= min_n))
    ci = S.bootstrap_mean_diff_ci(deltas, [group_col], "arm", "delta_mean", event_key, "treated", "control",
                                  n_boot=n_boot, alpha=alpha, seed=seed)
    return wt.join(ci, group_col).select(
        F.lit("DiD").alias("method"), F.col(group_col).alias("action_type"),
        (F.col("mean_a") - F.col("mean_b")).alias("ate_estimate"), "ci_lower", "ci_upper", "p_value",
        F.col("n_a").alias("n_treated"), F.col("n_b").alias("n_control"))


def psm_match(scored: DataFrame, *, row_key: str, treat_col: str, score_col: str,
              bucket_width: float = 0.01) -> DataFrame:
    """Each treated row's nearest control by propensity, with replacement
    (tie -> lower score, then lowest row key). Distributed 1-D nearest
    neighbour = key-less unbounded as-of join on the score."""
    treated = scored.where(F.col(treat_col) == 1)
    control = scored.where(F.col(treat_col) == 0).select(
        F.col(score_col).alias("c_score"), F.col(row_key).alias("c_key"))
    return asof_join(treated, control, on=score_col, right_on="c_score", direction="nearest",
                     bucket_width=bucket_width, right_tie="c_key", backward_takes="first")


def psm_effects(matched: DataFrame, control_values: DataFrame, *, row_key: str, group_col: str,
                outcome: str, n_boot: int = 2000, alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """K3: per group ATE = mean(treated - matched control), paired bootstrap
    CI, Welch p (unpaired, as the reference), n treated = n control."""
    cv = control_values.select(F.col(row_key).alias("c_key"), F.col(outcome).alias("c_outcome"))
    pairs = matched.join(cv, "c_key").select(row_key, group_col, F.col(outcome).alias("t_outcome"), "c_outcome")
    pairs = cut_lineage(pairs)   # one row per treated unit, read by two aggregates
    boot = S.bootstrap_paired(pairs, [group_col], "t_outcome", "c_outcome", row_key, n_boot, alpha, seed)
    long = (pairs.select(group_col, F.lit("t").alias("arm"), F.col("t_outcome").alias("y"))
            .unionByName(pairs.select(group_col, F.lit("c").alias("arm"), F.col("c_outcome").alias("y"))))
    wt = S.welch_test(long, [group_col], "arm", "y", "t", "c")
    return boot.join(wt.select(group_col, "p_value"), group_col).select(
        F.lit("PSM").alias("method"), F.col(group_col).alias("action_type"),
        F.col("diff").alias("ate_estimate"), "ci_lower", "ci_upper", "p_value",
        F.col("n").alias("n_treated"), F.col("n").alias("n_control"))


def rollups(pp: DataFrame, *, event_key: str, action: str, attack: str, severity: str,
            restoration_scale: float = 1000.0) -> dict[str, DataFrame]:
    """K5 / K6: roll-ups of the per-event table and best action per attack /
    severity (smallest mean delta; ties -> action name)."""
    by_action = pp.groupBy(action).agg(
        F.count(event_key).alias("n_events"), F.avg("pre_mean").alias("pre_mean"),
        F.avg("post_mean").alias("post_mean"), F.avg("delta_mean").alias("delta_mean"),
        F.stddev_samp("delta_mean").alias("delta_mean_std"), F.avg("delta_p95").alias("delta_p95"),
        (F.avg("restoration_time") / restoration_scale).alias("mean_restoration"))
    by_attack = pp.groupBy(action, attack).agg(
        F.count(event_key).alias("n"), F.avg("delta_mean").alias("delta_mean"),
        F.avg("delta_p95").alias("delta_p95"))
    by_sev = pp.where(F.col(severity).isNotNull()).groupBy(action, severity).agg(
        F.count(event_key).alias("n"), F.avg("delta_mean").alias("delta_mean"))
    heat = S.pivot_mean(pp, action, attack, "delta_mean")
    best_attack = by_attack.groupBy(attack).agg(
        F.min_by(F.struct(action, "delta_mean", "delta_p95"), F.struct("delta_mean", action)).alias("b")
    ).select(attack, F.col(f"b.{action}").alias("recommended_action"), "b.delta_mean", "b.delta_p95")
    best_sev = by_sev.groupBy(severity).agg(
        F.min_by(F.struct(action, "delta_mean"), F.struct("delta_mean", action)).alias("b")
    ).select(severity, F.col(f"b.{action}").alias("recommended_action"), "b.delta_mean")
    return {"by_action": by_action, "by_attack": by_attack, "by_severity": by_sev, "heatmap": heat,
            "best_by_attack": best_attack, "best_by_severity": best_sev}
