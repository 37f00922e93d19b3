"""Model parity rules (closed forms) and the early-stopping rule."""

import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tickwise.operators import models as M


def _data(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(0, 0.5, n)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(y=y, y_cls=(y > 3).astype(int))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(pdf))
    return df, X, y


def test_ridge_equals_closed_form(spark):
    df, X, y = _data(spark)
    m = M.ridge(df, "features", "y", alpha=1.0)
    # sklearn Ridge: intercept unpenalised -> centre X and y, solve (Xc'Xc + aI) w = Xc'yc
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + np.eye(3), Xc.T @ yc)
    b = y.mean() - X.mean(0) @ w
    np.testing.assert_allclose(m.coefficients.toArray(), w, rtol=1e-6)
    assert m.intercept == pytest.approx(b, rel=1e-6)


def test_balanced_weights(spark):
    pdf = pd.DataFrame({"y": [0] * 9 + [1]})
    w = M.balanced_weights(spark.createDataFrame(pdf), "y").toPandas()
    assert np.isclose(w[w.y == 0].class_weight.iloc[0], 10 / 18) and np.isclose(w[w.y == 1].class_weight.iloc[0], 5.0)
    assert np.isclose(w.class_weight.sum(), 10)


def test_mean_predictor_and_scoring(spark):
    df, _, y = _data(spark)
    assert M.mean_predictor(df, "y") == pytest.approx(y.mean())
    p = M.propensity_scores(df, "features", "y_cls").toPandas()
    assert p.propensity.between(0, 1).all()


def test_early_stopping_rule(spark):
    df, _, _ = _data(spark, 400, 1)
    tr, va = df.limit(300), df.subtract(df.limit(300))
    r = M.early_stopping_gbt(tr, va, "features", "y", classification=False, max_rounds=15, patience=3, max_depth=2)
    best = int(np.argmin(r.history[: r.best_iter + 3])) + 1
    assert r.best_iter == best and r.model.getNumTrees == r.best_iter


def test_early_stopping_keeps_a_fit_of_the_best_count(spark, monkeypatch):
    df, _, _ = _data(spark, 200, 2)
    fits, fit = [], M.gbt_regressor
    monkeypatch.setattr(M, "gbt_regressor", lambda *a, **k: fits.append(k["max_iter"]) or fit(*a, **k))
    r = M.early_stopping_gbt(df, df, "features", "y", classification=False, max_rounds=3, patience=3, max_depth=2)
    assert r.best_iter == 3 and fits == [3] and r.model.getNumTrees == 3


def test_training_rows_are_packed(spark, monkeypatch):
    df = spark.range(0, 1000, 1, 64)
    cores = spark.sparkContext.defaultParallelism
    assert M.packed(df).rdd.getNumPartitions() == min(cores, 64) and M.packed(df).count() == 1000
    monkeypatch.setattr(M, "TASK_ROWS", 25)
    assert M.packed(df).rdd.getNumPartitions() == max(cores, 40)


def test_independent_fits_run_side_by_side(spark):
    both = threading.Barrier(2, timeout=30)  # broken unless both run at once
    assert [v for v, _ in M.side_by_side(spark, [lambda: (1, both.wait()), lambda: (2, both.wait())])] == [1, 2]
    assert M.side_by_side(spark, []) == []


def test_sequence_flatten(spark):
    pdf = pd.DataFrame({"seq": [[[1.0, 2.0], [3.0, 4.0]]]})
    out = M.flatten_sequences(spark.createDataFrame(pdf)).first()["features"]
    assert list(out) == [1.0, 2.0, 3.0, 4.0]


def test_tree_contributions_identity(spark):
    from tickwise.operators.explain import mean_abs_contribution, tree_contributions
    df, _, _ = _data(spark, 300, 3)
    df = df.withColumn("rid", F.monotonically_increasing_id())
    m = M.gbt_regressor(df, "features", "y", max_iter=8, max_depth=3)
    c = tree_contributions(df, m, "features", "rid", ["a", "b", "c"])
    j = c.join(m.transform(df).select("rid", "prediction"), "rid").toPandas()
    np.testing.assert_allclose(j.explained, j.prediction, atol=1e-9)
    s = mean_abs_contribution(c, ["a", "b", "c"]).toPandas().set_index("feature")
    assert s.loc["b", "mean_abs_contribution"] > s.loc["c", "mean_abs_contribution"]   # |coef| 2.0 vs 0.5


def _expected_value(tree, x, known, node=0):
    """Value of a tree where features outside ``known`` follow the covers."""
    f = tree["feat"][node]
    if f < 0:
        return tree["val"][node]
    left, right = tree["left"][node], tree["right"][node]
    if f in known:
        return _expected_value(tree, x, known, left if x[f] <= tree["thr"][node] else right)
    share = tree["cover"][left] / tree["cover"][node]
    return share * _expected_value(tree, x, known, left) + (1 - share) * _expected_value(tree, x, known, right)


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_shapley_values_equal_all_subsets(spark, kind):
    from itertools import combinations
    from math import factorial

    from pyspark.ml.regression import RandomForestRegressor
    from tickwise.operators import explain as E
    df, X, _ = _data(spark, 400, 5)
    df = df.withColumn("rid", F.monotonically_increasing_id())
    if kind == "boosted":
        m = M.gbt_regressor(df, "features", "y", max_iter=4, max_depth=4)
    else:
        m = RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=4, seed=3).fit(df)
    trees, weights = E.ensemble_trees(m)
    X = X[:25].copy()
    X[3, 1] = np.nan  # goes right, as Spark's trees take it
    got_base, got = E.shapley_np(X, [(w, E.leaf_games(t)) for w, t in zip(weights, trees)])
    for x, row, base in zip(X, got, got_base):
        want = np.zeros(3)
        for f in range(3):
            others = [g for g in range(3) if g != f]
            for k in range(3):
                for s in combinations(others, k):
                    gain = sum(w * (_expected_value(t, x, {*s, f}) - _expected_value(t, x, set(s))) for w, t in zip(weights, trees))
                    want[f] += factorial(k) * factorial(2 - k) / 6 * gain
        np.testing.assert_allclose(row, want, atol=1e-10)
        assert base == pytest.approx(sum(w * _expected_value(t, x, set()) for w, t in zip(weights, trees)))
    c = E.tree_contributions(df, m, "features", "rid", ["a", "b", "c"])
    j = c.join(m.transform(df).select("rid", "prediction"), "rid").toPandas()
    np.testing.assert_allclose(j.explained, j.prediction, atol=1e-9)
    path = E.tree_contributions(df, m, "features", "rid", ["a", "b", "c"], method="path").join(
        m.transform(df).select("rid", "prediction"), "rid").toPandas()
    np.testing.assert_allclose(path.explained, path.prediction, atol=1e-9)


def test_class_weights_with_missing_labels(spark):
    rows = [(0,)] * 6 + [(1,)] * 2 + [(None,)]
    w = M.class_weights(spark.createDataFrame(rows, "y int").repartition(3), "y").where("y is not null").orderBy("y").collect()
    assert [(r.y, r["__nc"]) for r in w] == [(0, 6), (1, 2)]
    np.testing.assert_allclose([r.class_weight for r in w], [9 / (3 * 6), 9 / (3 * 2)])
    joined = M.balanced_weights(spark.createDataFrame(rows, "y int"), "y")
    assert joined.columns == ["y", "class_weight"] and joined.count() == 9 and joined.where("class_weight is null").count() == 1


def _alike(spark, copies=1):
    """Rows over few values, ``copies`` times each, and a class that follows them."""
    rows = spark.range(600).selectExpr("id", "cast(id % 40 as double) a", "cast(id * 7 % 11 as double) b", "cast(id * 13 % 50 as double) c")
    rows = rows.withColumn("y", F.col("a") * 3 + F.col("b") * F.col("c") + F.col("id") % 7).withColumn(
        "y_cls", (F.col("a") + F.col("id") % 17 > 25).cast("int"))
    rows = rows.crossJoin(spark.range(copies).select(F.col("id").alias("copy")))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)


def test_boosting_on_cells_is_sparks_own(spark):
    df = _alike(spark).cache()
    how = {"maxIter": 4, "maxDepth": 3, "seed": 42, "featuresCol": "features"}
    got = M.gbt_regressor(df, "features", "y", max_iter=4, max_depth=3)
    want = GBTRegressor(labelCol="y", **how).fit(df)
    p = lambda m, c="prediction": [r[0] for r in m.transform(df).orderBy("id").select(c).collect()]
    np.testing.assert_allclose(p(got), p(want), rtol=1e-9)
    np.testing.assert_allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-9)
    np.testing.assert_allclose(got.evaluateEachIteration(df, "squared"), want.evaluateEachIteration(df, "squared"), rtol=1e-9)
    got = M.gbt_classifier(df, "features", "y_cls", max_iter=4, max_depth=3, weighted=False)
    want = GBTClassifier(labelCol="y_cls", **how).fit(df)
    np.testing.assert_allclose([v[1] for v in p(got, "probability")], [v[1] for v in p(want, "probability")], rtol=1e-9)


def test_boosting_goes_over_cells_not_rows(spark):
    once, often = _alike(spark), _alike(spark, 50)
    few, many = (M.cells(df, "features", "y", "y_cls") for df in (once, often))
    size = lambda c: c.blocks.agg(F.sum("n")).first()[0]
    assert (few.n, many.n) == (600, 30_000) and size(few) == size(many) <= 600
    p = lambda m: [r[0] for r in m.transform(once).orderBy("id").select("prediction").collect()]
    for fit, label in ((M.gbt_regressor, "y"), (M.gbt_classifier, "y_cls")):
        a, b = (fit(c, "features", label, max_iter=3, max_depth=3) for c in (few, many))
        np.testing.assert_allclose(p(a), p(b), rtol=1e-9)


def test_rounds_draw_single_rows(spark, tmp_dir):
    df = _alike(spark, 3).cache()
    with pytest.raises(ValueError):
        M.gbt_regressor(M.cells(df, "features", "y"), "features", "y", max_iter=2, subsample=0.8)
    m = M.gbt_regressor(df, "features", "y", max_iter=6, max_depth=3, subsample=0.8, feature_subset="0.8")
    drawn = [t._java_obj.rootNode().impurityStats().count() for t in m.trees]
    assert len(set(drawn)) > 1 and all(abs(n - 1440) < 100 for n in drawn)
    m.write().save(f"{tmp_dir}/gbt")
    scores = lambda m: [r[0] for r in m.transform(df).orderBy("id", "copy").select("prediction").collect()]
    assert scores(type(m).load(f"{tmp_dir}/gbt")) == scores(m)
    assert np.corrcoef(scores(m), [r.y for r in df.orderBy("id", "copy").collect()])[0, 1] > 0.8


def test_boosting_refuses_missing_labels_and_values(spark):
    df = _alike(spark)
    for label, fit in (("y", M.gbt_regressor), ("y_cls", M.gbt_classifier)):
        with pytest.raises(Exception, match="labels must not be null"):
            fit(df.withColumn(label, F.when(F.col("id") != 5, F.col(label))), "features", label, max_iter=1)
    with pytest.raises(ValueError, match="NaN"):
        bad = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(
            df.drop("features").withColumn("a", F.when(F.col("id") != 5, F.col("a"))))
        M.gbt_regressor(bad, "features", "y", max_iter=1)
