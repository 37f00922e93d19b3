"""Metrics against brute-force definitions and the reference's metric fixtures."""

import numpy as np
import pandas as pd
import pytest

from tickwise.functions.expr import prob_flag
from tickwise.operators import evaluate as E


def test_reference_metric_fixtures(spark):
    reg = spark.createDataFrame(pd.DataFrame({"y": [1.0, 2.0, 3.0], "p": [1.1, 2.2, 2.8]}))
    m = E.regression_metrics(reg, "y", "p").toPandas().iloc[0]
    assert m.rmse >= m.mae >= 0
    y, p = np.array([1, 2, 3.0]), np.array([1.1, 2.2, 2.8])
    assert m.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    clf = spark.createDataFrame(pd.DataFrame({"y": [0, 0, 1, 1], "pred": [0, 1, 1, 1], "prob": [.1, .6, .8, .9]}))
    c = E.classification_metrics(clf, "y", "pred").toPandas().iloc[0]
    assert 0 <= c.accuracy <= 1 and c.accuracy == 0.75 and c.precision == pytest.approx(2 / 3)
    r = E.rank_metrics(clf, "y", "prob").toPandas().iloc[0]
    assert r.roc_auc == 1.0


def _pairwise_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def _step_ap(y, s):
    order = np.argsort(-s, kind="stable")
    ap, tp, fp, prev_r = 0.0, 0, 0, 0.0
    for v in np.unique(s)[::-1]:
        m = s == v
        tp += y[m].sum()
        fp += (1 - y[m]).sum()
        r = tp / y.sum()
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_auc_ap_with_ties(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 800)
    s = np.round(rng.random(800) + 0.3 * y, 1)        # heavy ties
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s, "g": rng.integers(0, 2, 800)}))
    r = E.rank_metrics(df, "y", "s").toPandas().iloc[0]
    assert r.roc_auc == pytest.approx(_pairwise_auc(y, s))
    assert r.avg_precision == pytest.approx(_step_ap(y, s))
    one = spark.createDataFrame(pd.DataFrame({"y": [1, 1], "s": [0.2, 0.4]}))
    assert pd.isna(E.rank_metrics(one, "y", "s").toPandas().iloc[0].roc_auc)


def test_zero_division_confusion_calibration_logloss(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [0, 0, 1], "p": [0.0, 0.05, 1.0]}))
    c = E.classification_metrics(df, "y", prob_flag("p", cut=2.0)).toPandas().iloc[0]
    assert c.precision == 0 and c.recall == 0 and c.f1 == 0
    cm = E.confusion(df, "y", prob_flag("p")).toPandas()
    assert cm["count"].sum() == 3
    cal = E.calibration(df, "y", "p").toPandas().sort_values("bin")
    assert list(cal.bin) == [0, 9]                    # 0 and 0.05 share the first bin, empty bins dropped
    ll = E.log_loss(df, "y", "p").toPandas().iloc[0].log_loss
    assert np.isfinite(ll)
    mape = E.regression_metrics(spark.createDataFrame(pd.DataFrame({"y": [0.0], "p": [1.0]})), "y", "p")
    assert mape.toPandas().iloc[0].mape == pytest.approx(1e10)   # 1e-8 guard
