"""Evaluation operators.

Metrics are single grouped aggregates (optionally per slice). Rank metrics
(ROC-AUC, average precision, curve points) work on the table of distinct
scores with running totals from ``order.cumulative_sums`` (range partitioned,
no single-partition window), so ties get average ranks exactly like
scikit-learn.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast
from . import stats as S
from .order import cumulative_sums

EPS = float(np.finfo(float).eps)


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R^2 (1 - SSE / SST with centred SST), MAPE (%) with the
    1e-8 guard; ``n`` rows."""
    e = F.col(y) - F.col(p)
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("__sse"), (F.var_pop(y) * F.count(y)).alias("__sst"),
        (F.avg(F.abs(e / (F.col(y) + F.lit(1e-8)))) * 100).alias("mape"))
    r2 = F.when(F.col("__sst") > 0, 1 - F.col("__sse") / F.col("__sst")).otherwise(
        F.when(F.col("__sse") == 0, 1.0).otherwise(0.0))
    return g.select(*by, "n", "mae", F.sqrt("mse").alias("rmse"), r2.alias("r2"), "mape")


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def classification_metrics(df: DataFrame, y: str, pred: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1; zero division -> 0."""
    yt, yp = F.col(y).cast("int"), _c(pred).cast("int")
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(((yt == 1) & (yp == 1)).cast("long")).alias("tp"),
        F.sum(((yt == 0) & (yp == 1)).cast("long")).alias("fp"),
        F.sum(((yt == 1) & (yp == 0)).cast("long")).alias("fn"),
        F.sum(((yt == 0) & (yp == 0)).cast("long")).alias("tn"))
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return g.select(*by, "n", ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def score_table(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score (descending), cumulative TP / FP at threshold
    ``>= score`` and the curve points (fpr, tpr, precision, recall)."""
    g = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"), F.sum((F.col(y) != 1).cast("long")).alias("neg"))
    c = cumulative_sums(g, [F.col(score).desc()], ["pos", "neg"], partition_by=by)
    tot = g.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    c = c.join(checked_broadcast(tot), list(by)) if by else S.attach_row(c, tot)
    return c.select(*by, score, "pos", "neg", F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                    "n_pos", "n_neg",
                    _safe_div(F.col("neg_cum"), F.col("n_neg")).alias("fpr"),
                    _safe_div(F.col("pos_cum"), F.col("n_pos")).alias("tpr"),
                    (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))).alias("precision"),
                    _safe_div(F.col("pos_cum"), F.col("n_pos")).alias("recall"))


def rank_metrics(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """E3 + E4: ROC-AUC = P(s+ > s-) + 0.5 P(s+ = s-) (average ranks) and
    step-wise average precision sum(dR * P); null when one class only."""
    t = score_table(df, y, score, by)
    neg_below = F.col("n_neg") - F.col("fp")          # negatives with a lower score
    g = t.groupBy(*by).agg(
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"),
        F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))).alias("__u"),
        F.sum(F.col("pos") * F.col("precision")).alias("__ap"))
    one_class = (F.col("n_pos") == 0) | (F.col("n_neg") == 0)
    auc = F.when(one_class, F.lit(None)).otherwise(F.col("__u") / (F.col("n_pos") * F.col("n_neg")))
    ap = F.when(one_class, F.lit(None)).otherwise(F.col("__ap") / F.col("n_pos"))
    return g.select(*by, auc.cast("double").alias("roc_auc"), ap.cast("double").alias("avg_precision"))


def log_loss(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """E5: mean binary cross-entropy with p clipped to [eps, 1 - eps]."""
    pc = F.least(F.greatest(F.col(p), F.lit(EPS)), F.lit(1 - EPS))
    ll = -(F.col(y) * F.log(pc) + (1 - F.col(y)) * F.log(1 - pc))
    return df.groupBy(*by).agg(F.avg(ll).alias("log_loss"))


def confusion(df: DataFrame, y: str, pred: str | Column) -> DataFrame:
    """Counts per (true, predicted) and the row-normalised share."""
    g = df.groupBy(F.col(y).cast("int").alias("y_true"), _c(pred).cast("int").alias("y_pred")).agg(
        F.count(F.lit(1)).alias("count"))
    tot = g.groupBy("y_true").agg(F.sum("count").alias("__row"))
    return g.join(F.broadcast(tot), "y_true").select(
        "y_true", "y_pred", "count", (F.col("count") / F.col("__row")).alias("share"))


def calibration(df: DataFrame, y: str, p: str, n_bins: int = 10) -> DataFrame:
    """Uniform right-closed bins, empty bins dropped; (bin, mean p, mean y).
    A bin is the number of inner edges below the score; the edges are doubles
    ``i * (1 / n)``, so a score on an edge falls where comparing puts it."""
    edges = [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)[1:-1]]
    b = sum(((F.col(p) > e).cast("int") for e in edges), F.lit(0))
    return df.where(F.col(p).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("prob_pred"), F.avg(F.col(y).cast("double")).alias("prob_true"))


def per_key_metrics_topk(df: DataFrame, key: str, y: str, p: str, y_cls: str, score: str,
                         flag: str | Column, k: int = 10, min_rows: int = 2) -> DataFrame:
    """The ``k`` keys with most positives; keys with < ``min_rows`` rows
    are skipped; rank metrics are null for one-class keys."""
    top = S.top_k_groups_by_sum(df, key, y_cls, k, name="n_violations")
    x = df.join(F.broadcast(top.select(key)), key, "left_semi")
    reg = regression_metrics(x, y, p, by=[key])
    clf = classification_metrics(x, y_cls, flag, by=[key]).drop("n")
    rk = rank_metrics(x, y_cls, score, by=[key])
    return (reg.join(clf, key).join(rk, key, "left").join(top, key)
               .where(F.col("n") >= min_rows))
