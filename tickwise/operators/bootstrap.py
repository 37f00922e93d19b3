"""Paired bootstrap tests of metrics.

Two predictions of the same rows are compared on a metric; both share the
Poisson weights of a replicate. A metric is either a formula of weighted sums
over rows (``SumMetric``: error means, confusion counts, anything a caller
states in Columns), or a rank metric (``AUC``), which needs the rows in score
order: rows are dealt to equi-depth blocks of the score, a task walks through a
block once with all replicates side by side, and blocks are put together from
their totals. Nothing of the size rows x replicates is ever shuffled, and no
task holds more than one replicate vector per running sum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import poisson1_weights, unit_weights
from .buckets import fit_depth_buckets
from .stats import CHUNK_ROWS, attach_row, chunk_rows, dealt, weighted_partials

Weights = Callable[[np.ndarray, int, int], np.ndarray]


@dataclass(frozen=True)
class SumMetric:
    """``terms(label, prediction)``: Columns whose weighted sums the metric
    needs; ``value(sums)``: the metric, ``sums["w"]`` the sum of weights."""
    terms: Callable[[Column, Column], Mapping[str, Column]]
    value: Callable[[Mapping[str, Column]], Column]


def _f1_terms(y: Column, p: Column) -> dict[str, Column]:
    hit = lambda a, b: ((y == a) & (p == b)).cast("double")
    return {"tp": hit(1, 1), "fp": hit(0, 1), "fn": hit(1, 0)}


MAE = SumMetric(lambda y, p: {"error": F.abs(y - p)}, lambda s: s["error"] / s["w"])
RMSE = SumMetric(lambda y, p: {"square": (y - p) * (y - p)}, lambda s: F.sqrt(s["square"] / s["w"]))
ACCURACY = SumMetric(lambda y, p: {"right": (y == p).cast("double")}, lambda s: s["right"] / s["w"])
#: F1 of class 1; 0 if there is neither a positive nor a predicted one.
F1 = SumMetric(_f1_terms, lambda s: F.coalesce(F.try_divide(2 * s["tp"], 2 * s["tp"] + s["fp"] + s["fn"]), F.lit(0.0)))
AUC = "auc"


def _sum_replicates(df: DataFrame, by: list[str], y: str, preds: Sequence[str], metric: SumMetric, row_key: str, n_boot: int, seed: int,
                    weights: Weights) -> DataFrame:
    """(by, rep, m0, m1): the metric of both predictions per replicate."""
    cols = {f"t{i}_{name}": c.cast("double") for i, p in enumerate(preds) for name, c in metric.terms(F.col(y), F.col(p)).items()}
    part = weighted_partials(df.select(*by, row_key, *[c.alias(n) for n, c in cols.items()]), by, row_key, list(cols), n_boot, seed, weights)
    sums = lambda i: {"w": F.col("sw")} | {n.split("_", 1)[1]: F.col(f"s_{n}") for n in cols if n.startswith(f"t{i}_")}
    return part.select(*by, "rep", *[metric.value(sums(i)).alias(f"m{i}") for i in range(len(preds))])


class _BlockRanks:
    """Running sums of one score-ordered block, replicates side by side."""

    def __init__(self, n_boot: int):
        self.pos, self.neg, self.pairs = (np.zeros(n_boot) for _ in range(3))
        self.score, self.tied = None, (np.zeros(n_boot), np.zeros(n_boot))

    def add(self, score: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        """Rows in score order; the last tie stays open, as more may follow."""
        start = np.flatnonzero(np.r_[True, score[1:] != score[:-1]])
        pos, neg = (np.add.reduceat(w * side[:, None], start, axis=0) for side in (y, 1 - y))
        if self.score == score[0]:
            pos[0] += self.tied[0]
            neg[0] += self.tied[1]
        else:
            self.close()
        below = self.neg + np.cumsum(neg[:-1], axis=0) - neg[:-1]
        self.pairs += (pos[:-1] * (below + neg[:-1] / 2)).sum(axis=0)
        self.pos += pos[:-1].sum(axis=0)
        self.neg += neg[:-1].sum(axis=0)
        self.score, self.tied = score[-1], (pos[-1], neg[-1])

    def close(self) -> None:
        pos, neg = self.tied
        self.pairs += pos * (self.neg + neg / 2)
        self.pos += pos
        self.neg += neg
        self.score, self.tied = None, (np.zeros_like(pos), np.zeros_like(neg))


def _auc_replicates(df: DataFrame, by: list[str], y: str, score: str, row_key: str, n_boot: int, seed: int, weights: Weights, out: str,
                    target_rows: int) -> DataFrame:
    """(by, rep, out): weighted share of (positive, negative) pairs in the right
    order, ties one half; null without both classes."""
    x = df.select(*by, F.col(row_key).alias("key"), F.col(y).cast("double").alias("y"), F.col(score).cast("double").alias("score"))
    x = fit_depth_buckets(x, "score", target_rows).assign(x, "score", "block")
    x = dealt(x, [*by, "block"]).sortWithinPartitions(*by, "block", "score")
    chunk = chunk_rows(n_boot, CHUNK_ROWS)
    shape = T.StructType([*[x.schema[k] for k in by], T.StructField("block", T.IntegerType()), T.StructField("rep", T.IntegerType()),
                          *[T.StructField(c, T.DoubleType()) for c in ("pos", "neg", "pairs")]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ranks = None, None

        def told() -> pd.DataFrame:
            ranks.close()
            return pd.DataFrame({**{k: [v] * n_boot for k, v in zip([*by, "block"], key)}, "rep": np.arange(n_boot, dtype=np.int32),
                                 "pos": ranks.pos, "neg": ranks.neg, "pairs": ranks.pairs})[shape.names]

        for pdf in batches:
            for k, part in pdf.groupby([*by, "block"], sort=False, dropna=False):
                k = tuple(None if v != v else v for v in k)
                if k != key:
                    if ranks is not None:
                        yield told()
                    key, ranks = k, _BlockRanks(n_boot)
                for lo in range(0, len(part), chunk):
                    rows = part.iloc[lo:lo + chunk]
                    w = weights(rows["key"].to_numpy(dtype=np.int64), n_boot, seed).astype(np.float64)
                    ranks.add(rows["score"].to_numpy(), rows["y"].to_numpy(), w)
        if ranks is not None:
            yield told()

    parts = x.mapInPandas(run, shape)
    # one row per block and replicate
    before = Window.partitionBy(*by, "rep").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("below", F.coalesce(F.sum("neg").over(before), F.lit(0.0)))
    whole = parts.groupBy(*by, "rep").agg(F.sum(F.col("pairs") + F.col("pos") * F.col("below")).alias("p"), F.sum("pos").alias("a"), F.sum("neg").alias("b"))
    return whole.select(*by, "rep", F.try_divide("p", F.col("a") * F.col("b")).alias(out))


def metric_bootstrap(df: DataFrame, y: str, preds: tuple[str, str], metric: SumMetric | str, row_key: str, by: Sequence[str] = (),
                     n_boot: int = 2000, alpha: float = 0.05, seed: int = 42, weights: Weights = poisson1_weights,
                     target_rows: int = 20_000) -> DataFrame:
    """(by, n, metric_a, metric_b, diff, ci_lower, ci_upper, p_value): metric of
    both predictions, percentile interval of their difference, and the share of
    replicates on the other side of 0 from the observed difference. Rows with a
    null or NaN label or prediction are left out; ``row_key`` is an integer."""
    by = list(by)
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    x = df.where(number(y) & number(preds[0]) & number(preds[1])).select(*by, row_key, y, *dict.fromkeys(preds))

    def replicates(times: int, how: Weights) -> DataFrame:
        if isinstance(metric, SumMetric):
            return _sum_replicates(x, by, y, preds, metric, row_key, times, seed, how)
        if metric != AUC:
            raise ValueError(f"unknown metric {metric!r}: a SumMetric or {AUC!r}")
        a, b = (_auc_replicates(x, by, y, p, row_key, times, seed, how, out, target_rows) for p, out in zip(preds, ("m0", "m1")))
        return a.join(b, [*by, "rep"])

    seen = replicates(1, unit_weights).select(*by, F.col("m0").alias("metric_a"), F.col("m1").alias("metric_b"), (F.col("m0") - F.col("m1")).alias("diff"))
    n = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    seen = seen.join(n, by) if by else attach_row(seen, n)
    d = replicates(n_boot, weights).select(*by, (F.col("m0") - F.col("m1")).alias("d"))
    d = d.join(seen, by) if by else attach_row(d, seen)
    other = F.when(F.col("diff") <= 0, F.col("d") >= 0).otherwise(F.col("d") <= 0).cast("double")
    res = d.groupBy(*by, "n", "metric_a", "metric_b", "diff").agg(
        F.percentile("d", [alpha / 2, 1 - alpha / 2]).alias("ci"), F.avg(other).alias("p_value"))
    return res.select(*by, "n", "metric_a", "metric_b", "diff", F.col("ci")[0].alias("ci_lower"), F.col("ci")[1].alias("ci_upper"), "p_value")
