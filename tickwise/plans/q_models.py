"""Model queries (rows-only checks): training, early stopping, stacking,
random search over expanding folds, sequence model, scoring, importances,
noise robustness, drift, comparison, worst-case traces (M1-M12, E10, E11,
E13, E15).

Data: line items joined with parts; regression target ``l_extendedprice``,
classification target ``l_returnflag = 'R'``; chronological 70/15/15 split.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import prob_flag
from ..operators import evaluate as E
from ..operators import models as M
from ..operators import stats as S
from ..operators.encode import EncoderSpec, fit_encoder
from ..operators.order import ROW_IDX, chrono_split, expanding_folds
from ..operators.sample import hashed_normal
from ..operators.window import context_rows, sliding_sequences
from ..session import cut_lineage
from ..sources.tables import Tables
from .registry import register, round_doubles

FEATS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SMALL_GBT = {"max_iter": 20, "max_depth": 4}


def model_table(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size"),
                         "l_partkey")
    li = li.select(*ORDER, *FEATS, F.col("l_extendedprice").alias("y"),
                   (F.col("l_returnflag") == "R").cast("int").alias("y_cls"))
    split = chrono_split(li, ORDER)
    return VectorAssembler(inputCols=FEATS, outputCol="features").transform(split)


def _parts(df):
    return (df.where(F.col("split") == "train"), df.where(F.col("split") == "val"),
            df.where(F.col("split") == "test"))


def _reg_eval(name: str, scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return E.regression_metrics(scored, "y", "prediction", by).select(F.lit(name).alias("model"), "*")


def _clf_eval(name: str, scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    s = scored.withColumn("score", vector_to_array("probability")[1])
    c, *more = (E.classification_metrics(s, "y_cls", prob_flag("score"), by), E.rank_metrics(s, "y_cls", "score", by),
                E.log_loss(s, "y_cls", "score", by))
    for m in more:
        c = c.join(m, list(by)) if by else S.attach_row(c, m)
    return c.select(F.lit(name).alias("model"), "*")


def _both_tasks(reg: list[DataFrame], clf: list[DataFrame]) -> DataFrame:
    """Regression and classification rows under one header; a metric of the
    other task is null."""
    out = None
    for task, frames in (("regression", reg), ("classification", clf)):
        for f in frames:
            f = f.withColumn("task", F.lit(task))
            out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


@register("M1_M2_M3_E13_regression_models")
def m_reg(spark, sf_dir):
    """Mean predictor, ridge (alpha=1), boosted trees, and the balanced logistic
    and class-weighted boosted classifiers; test metrics in long form with best /
    worst of each task (by MAE, by F1) and % improvement over the mean predictor."""
    d = cut_lineage(model_table(spark, sf_dir))  # written once for the three fits and their scoring
    tr, _va, te = _parts(d)
    cells = M.cells(tr, "features", "y", "y_cls")
    mu, *models = M.side_by_side(spark, [
        lambda: M.mean_predictor(tr, "y"), lambda: M.ridge(tr, "features", "y"),
        lambda: M.gbt_regressor(cells, "features", "y", **SMALL_GBT),
        lambda: M.balanced_logistic(tr, "features", "y_cls"), lambda: M.gbt_classifier(cells, "features", "y_cls", **SMALL_GBT)])
    rows = [_reg_eval("mean", M.predict_constant(te, mu)),
            *[_reg_eval(name, m.transform(te)) for name, m in zip(("ridge", "gbt"), models[:2])]]
    clf = M.side_by_side(spark, [lambda name=name, m=m: _clf_eval(name, m.transform(te))
                                 for name, m in zip(("logistic_balanced", "gbt_weighted"), models[2:])])
    out = _both_tasks(rows, clf)
    base = out.where(F.col("model") == "mean").select(F.col("mae").alias("__base"))
    out = S.attach_row(out, base).withColumn(
        "improvement_pct", (F.col("__base") - F.col("mae")) / F.col("__base") * 100).drop("__base")
    out = out.withColumn("__loss", F.coalesce("mae", -F.col("f1")))
    ends = out.groupBy("task").agg(F.min("__loss").alias("__best"), F.max("__loss").alias("__worst"))
    out = out.join(F.broadcast(ends), "task").withColumns(
        {"best": F.col("__loss") == F.col("__best"), "worst": F.col("__loss") == F.col("__worst")}).drop("__loss")
    return round_doubles(out.drop("__best", "__worst"))


@register("M4_M5_classification_models")
def m_clf(spark, sf_dir):
    """Balanced logistic regression and class-weighted boosted trees; test
    accuracy / precision / recall / F1 / ROC-AUC / AP / log loss."""
    d = model_table(spark, sf_dir)
    tr, _va, te = _parts(d)
    res = M.side_by_side(spark, [
        lambda: _clf_eval("logistic_balanced", M.balanced_logistic(tr, "features", "y_cls").transform(te)),
        lambda: _clf_eval("gbt_weighted", M.gbt_classifier(tr, "features", "y_cls", **SMALL_GBT).transform(te))])
    return round_doubles(res[0].unionByName(res[1]))


@register("M6_early_stopping")
def m6(spark, sf_dir):
    """Boosted trees with validation early stopping (patience rule) for both
    tasks; best iteration and validation loss per round."""
    d = model_table(spark, sf_dir)
    tr, va, _te = _parts(d)
    tasks = (("regression", "y", False), ("classification", "y_cls", True))
    cells = M.cells(tr, "features", "y", "y_cls")
    got = M.side_by_side(spark, [lambda label=label, cls=cls: M.early_stopping_gbt(
        cells, va, "features", label, classification=cls, max_rounds=40, patience=5, max_depth=3) for _, label, cls in tasks])
    rows = [(task, i + 1, float(v), r.best_iter) for (task, *_), r in zip(tasks, got) for i, v in enumerate(r.history)]
    return spark.createDataFrame(rows, "task string, round int, val_loss double, best_iter int")


@register("M7_stacking_ensemble")
def m7(spark, sf_dir):
    """Three bases a task on train (linear, boosted trees, boosted trees over
    sampled rows and columns), a ridge / logistic meta learner on their
    validation predictions; test metrics of bases and ensembles."""
    d = cut_lineage(model_table(spark, sf_dir))  # written once for the eight fits and their scoring
    tr, va, te = _parts(d)
    sampled = {"subsample": 0.8, "feature_subset": "0.8", **SMALL_GBT}
    cells = M.cells(tr, "features", "y", "y_cls")
    single = M.cells(tr, "features", "y", "y_cls", added=False, like=cells)  # rounds draw single rows
    bases = M.side_by_side(spark, [
        lambda: M.ridge(tr, "features", "y"), lambda: M.gbt_regressor(cells, "features", "y", **SMALL_GBT),
        lambda: M.gbt_regressor(single, "features", "y", **sampled),
        lambda: M.balanced_logistic(tr, "features", "y_cls"), lambda: M.gbt_classifier(cells, "features", "y_cls", **SMALL_GBT),
        lambda: M.gbt_classifier(single, "features", "y_cls", **sampled)])
    parts = []
    for of, label, ev, is_clf in ((bases[:3], "y", _reg_eval, False), (bases[3:], "y_cls", _clf_eval, True)):
        _meta, score = M.stacking(tr, va, "features", label, of, classification=is_clf)
        parts += [lambda ev=ev, score=score: ev("stacking", score(te)),
                  *[lambda ev=ev, i=i, b=b: ev(f"base_{i}", b.transform(te)) for i, b in enumerate(of)]]
    rows = M.side_by_side(spark, parts)  # rank metrics run jobs of their own
    return round_doubles(_both_tasks(rows[:4], rows[4:]))


def sample_configs(n: int, seed: int = 42) -> list[dict]:
    """Seeded independent draws per grid axis (repeats allowed)."""
    rng = random.Random(seed)
    grid = {"max_depth": [2, 3, 4, 5], "step": [0.05, 0.1, 0.2], "max_iter": [10, 20, 30]}
    return [{k: rng.choice(v) for k, v in grid.items()} for _ in range(n)]


@register("M8_W10_random_search_expanding_cv")
def m8(spark, sf_dir):
    """4 sampled configs x 3 expanding folds on the train+val rows, for both
    tasks: mean and population std over folds (A23) of MAE / log loss per
    config, best first (T6). The encoder is fitted on each fold's train rows;
    the encoded fold is built once and reused by every fit."""
    d = model_table(spark, sf_dir).where(F.col("split") != "test").drop(ROW_IDX, "split", "features")
    folds = cut_lineage(expanding_folds(d, ORDER, n_splits=3))
    configs, fits = sample_configs(4), []
    for k in (1, 2, 3):
        fold = folds.where(F.col("fold") == k)
        enc = fit_encoder(fold.where(F.col("role") == "train"), EncoderSpec(numeric=FEATS))
        coded = cut_lineage(enc.transform(fold, keep=["role", "y", "y_cls"], assemble="features"))
        tr, va = M.cells(coded.where(F.col("role") == "train"), "features", "y", "y_cls"), coded.where(F.col("role") == "val")
        for ci, cfg in enumerate(configs):
            how = {"max_iter": cfg["max_iter"], "max_depth": cfg["max_depth"], "step": cfg["step"]}
            for task, fit, label in (("regression", M.gbt_regressor, "y"), ("classification", M.gbt_classifier, "y_cls")):
                fits.append((task, k, ci, va, lambda fit=fit, tr=tr, label=label, how=how: fit(tr, "features", label, **how)))
    # the large fits first, so that none is left to run alone at the end
    fits.sort(key=lambda f: (-f[1] * configs[f[2]]["max_iter"] * configs[f[2]]["max_depth"], f[:3]))
    rows = []
    for (task, k, ci, va, _), m in zip(fits, M.side_by_side(spark, [f[-1] for f in fits])):
        if task == "regression":
            metric, r = "mae", E.regression_metrics(m.transform(va), "y", "prediction")
        else:
            scored = m.transform(va).withColumn("score", vector_to_array("probability")[1])
            metric, r = "log_loss", E.log_loss(scored, "y_cls", "score")
        params = F.struct(*[F.lit(v).alias(p) for p, v in sorted(configs[ci].items())])
        rows.append(r.select(F.lit(task).alias("task"), F.lit(metric).alias("metric"), F.lit(ci).alias("config"),
                             params.alias("params"), F.lit(k).alias("fold"), F.col(metric).alias("value")))
    allr = rows[0]
    for r in rows[1:]:
        allr = allr.unionByName(r)
    res = S.mean_popstd(allr, ["task", "metric", "config", "params"], "value")
    # C17: flatten the nested parameter struct into columns; T6: best first
    return round_doubles(res.select("task", "metric", "config", "params.*", "mean", "std").orderBy("task", "mean", "config"))


@register("M10_W11_sequence_model")
def m10(spark, sf_dir):
    """Per-user windows of 10 events -> flattened vector -> linear regression
    of the last value; chronological split of the windows by end time."""
    from ..session import micros
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "value", micros("ts").alias("t_us"))
    seq = sliding_sequences(ev, ["t_us", "event_id"], ["value"], 10, target_col="value",
                            partition_by=["user_id"], keep=["t_us", "event_id"])
    # the input window excludes the target step
    seq = seq.withColumn("seq", F.slice("seq", 1, 9))
    seq = M.flatten_sequences(seq, "seq", "features").withColumnRenamed(ROW_IDX, "pos_in_user")
    seq = chrono_split(seq, ["t_us", "event_id"])
    tr = seq.where(F.col("split") == "train")
    te = seq.where(F.col("split") == "test")
    m = M.ridge(tr, "features", "target")
    return round_doubles(E.regression_metrics(m.transform(te), "target", "prediction"))


@register("M11_batch_scoring")
def m11(spark, sf_dir):
    """Score every row: predicted value, violation probability, flag (>= 0.5)."""
    d = model_table(spark, sf_dir)
    # the fits' passes read the assembled train rows from the block store, which spills
    tr = _parts(d)[0].select("features", "y", "y_cls").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        reg, clf = M.side_by_side(spark, [lambda: M.ridge(tr, "features", "y"),
                                          lambda: M.balanced_logistic(tr, "features", "y_cls")])
    finally:
        tr.unpersist()
    s = reg.transform(d).withColumnRenamed("prediction", "predicted_y")
    s = clf.transform(s).withColumn("violation_probability", vector_to_array("probability")[1])
    return round_doubles(s.select(ROW_IDX, "predicted_y", "violation_probability",
                                  prob_flag("violation_probability").alias("violation_flag")))


@register("M12_feature_importances")
def m12(spark, sf_dir):
    d = model_table(spark, sf_dir)
    tr, _va, _te = _parts(d)
    m = M.gbt_regressor(tr, "features", "y", **SMALL_GBT)
    return round_doubles(M.feature_importances(spark, m, FEATS, top=20))


def _fit_three(tr: DataFrame) -> list:
    """(name, evaluation, model): ridge, boosted trees, class-weighted boosted trees."""
    cells = M.cells(tr, "features", "y", "y_cls")
    fits = (("ridge", _reg_eval, lambda: M.ridge(tr, "features", "y")),
            ("gbt", _reg_eval, lambda: M.gbt_regressor(cells, "features", "y", **SMALL_GBT)),
            ("gbt_weighted", _clf_eval, lambda: M.gbt_classifier(cells, "features", "y_cls", **SMALL_GBT)))
    models = M.side_by_side(tr.sparkSession, [fit for *_, fit in fits])
    return [(name, ev, m) for (name, ev, _), m in zip(fits, models)]


@register("E10_noise_robustness")
def e10(spark, sf_dir):
    """Ridge, boosted trees and the boosted classifier fitted once; test rows
    re-scored with Gaussian noise on two inputs at 0, 0.5 and 2 sigma; metrics
    per (column, level)."""
    d = cut_lineage(model_table(spark, sf_dir))  # written once for the three fits and their scoring
    tr, _va, te = _parts(d)
    te = te.drop("features")
    va = VectorAssembler(inputCols=FEATS, outputCol="features")
    noisy = None
    for col in ("l_quantity", "l_discount"):
        sigma = te.agg(F.stddev_samp(col)).first()[0] or 0.0
        for lvl in (0.0, 0.5, 2.0):
            one = te.withColumn(col, F.col(col) + hashed_normal(ROW_IDX, 42) * F.lit(lvl * sigma)).withColumns(
                {"column": F.lit(col), "level": F.lit(lvl)})
            noisy = one if noisy is None else noisy.unionByName(one)
    noisy, by = va.transform(noisy), ["column", "level"]
    rows = {_reg_eval: [], _clf_eval: []}
    for name, ev, m in _fit_three(tr):
        rows[ev].append(ev(name, m.transform(noisy), by))
    return round_doubles(_both_tasks(rows[_reg_eval], rows[_clf_eval]))


@register("E11_drift_train60_test40")
def e11(spark, sf_dir):
    """Models on the first 60 % vs models on the first 70 % (the reference's full
    models), regression and classification, scored on the last 40 % and on the
    non-overlapping last 30 %."""
    base = cut_lineage(model_table(spark, sf_dir))  # written once for the six fits and their scoring
    n = base.count()
    a, b = int(n * 0.6), int(n * 0.7)
    test = base.where(F.col(ROW_IDX) >= a).withColumn("test_slice", F.explode(F.when(
        F.col(ROW_IDX) >= b, F.array(F.lit("last40"), F.lit("last30_no_overlap"))).otherwise(F.array(F.lit("last40")))))
    rows = {_reg_eval: [], _clf_eval: []}
    spans = (("train60", a), ("train70", b))
    fitted = M.side_by_side(spark, [lambda end=end: _fit_three(base.where(F.col(ROW_IDX) < end)) for _, end in spans])
    for (trained, _), models in zip(spans, fitted):
        for name, ev, m in models:
            rows[ev].append(ev(name, m.transform(test), ["test_slice"]).withColumn("trained", F.lit(trained)))
    return round_doubles(_both_tasks(rows[_reg_eval], rows[_clf_eval]))


@register("E15_T4_W13_worst_case_traces")
def e15(spark, sf_dir):
    """10 largest absolute errors of the ridge model on test (T4) with their
    +-10-row context windows (W13), and of each worst row the value and the
    contribution (coefficient x distance from the train mean) of every feature,
    ranked by mean |contribution| over test (T5)."""
    d = cut_lineage(model_table(spark, sf_dir))
    tr, _va, te = _parts(d)
    m = M.ridge(tr, "features", "y")
    mu = tr.agg(*[F.avg(f).alias(f) for f in FEATS]).first()
    parts = {f: (F.col(f) - F.lit(float(mu[f] or 0.0))) * F.lit(float(w)) for f, w in zip(FEATS, m.coefficients.toArray())}
    s = m.transform(d).withColumn("abs_error", F.abs(F.col("y") - F.col("prediction")))
    n = d.count()
    worst = s.where(F.col("split") == "test").orderBy(F.col("abs_error").desc(), ROW_IDX).limit(10).select(ROW_IDX, *FEATS)
    ctx = context_rows(s.select(ROW_IDX, "y", "prediction", "abs_error"), worst.select(ROW_IDX), n)
    size = te.agg(*[F.avg(F.abs(c)).alias(f) for f, c in parts.items()]).first()  # one row of a value per feature
    top = sorted(FEATS, key=lambda f: (-(size[f] or 0.0), f))[:10]
    values = worst.select(F.col(ROW_IDX).alias("centre_idx"), *[x for r, f in enumerate(top, 1) for x in (
        F.lit(f).alias(f"top{r}_feature"), F.col(f).cast("double").alias(f"top{r}_value"),
        parts[f].cast("double").alias(f"top{r}_contribution"))])
    return round_doubles(ctx.join(F.broadcast(values), "centre_idx"))


@register("M13_T5_tree_contributions")
def m13(spark, sf_dir):
    """Per-row additive contributions of the boosted-tree model for every test
    row, by ``kind`` of row: ``feature``, mean |contribution| and the largest
    deviation of base + sum(contributions) from the model prediction (should be
    ~0); ``device``, mean |contribution| within the 5 suppliers with most test
    rows; ``dependence``, (value, contribution) of every test row for the top 5
    features."""
    from ..operators.explain import mean_abs_contribution, tree_contributions
    d = cut_lineage(model_table(spark, sf_dir))
    tr, _va, te = _parts(d)
    m = M.gbt_regressor(tr, "features", "y", **SMALL_GBT)
    c = tree_contributions(te, m, "features", ROW_IDX, FEATS)
    c = cut_lineage(c.join(m.transform(te).select(ROW_IDX, "prediction", "l_suppkey", *FEATS), ROW_IDX))
    check = c.agg(F.max(F.abs(F.col("explained") - F.col("prediction"))).alias("max_identity_error"))
    summary = S.attach_row(mean_abs_contribution(c, FEATS), check).withColumn("kind", F.lit("feature"))
    # at most one row per feature reaches the driver
    top = [r["feature"] for r in summary.orderBy(F.col("mean_abs_contribution").desc(), "feature").limit(5).collect()]
    devices = c.groupBy("l_suppkey").count().orderBy(F.col("count").desc(), "l_suppkey").limit(5).select("l_suppkey")
    device = mean_abs_contribution(c.join(F.broadcast(devices), "l_suppkey"), FEATS, ["l_suppkey"]).withColumn("kind", F.lit("device"))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                               F.col(f"contrib_{f}").alias("contribution")) for f in top])
    dependence = c.select(F.lit("dependence").alias("kind"), ROW_IDX, F.explode(pairs).alias("s")).select("kind", ROW_IDX, "s.*")
    out = summary.unionByName(device, allowMissingColumns=True).unionByName(dependence, allowMissingColumns=True)
    return round_doubles(out.orderBy(F.col("kind").desc(), "l_suppkey", F.col("mean_abs_contribution").desc(), "feature", ROW_IDX))
