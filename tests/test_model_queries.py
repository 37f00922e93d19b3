"""The model queries do both tasks and give every output of their survey line."""

import pytest

from conftest import SF
from tickwise.plans import q_models as Q


@pytest.fixture
def small(spark, monkeypatch):
    monkeypatch.setattr(Q, "SMALL_GBT", {"max_iter": 2, "max_depth": 2})
    monkeypatch.setattr(Q, "sample_configs", lambda n, seed=42: [{"max_depth": 2, "step": 0.1, "max_iter": 2}])
    return spark


def by_task(rows, *keys):
    out = {}
    for r in rows:
        out.setdefault(r.task, set()).add(tuple(r[k] for k in keys))
        shown = r.mae if r.task == "regression" else r.log_loss
        assert shown is not None and (r.mae is None) == (r.task == "classification")
    return out


def test_comparison_has_both_tasks(small):
    rows = Q.m_reg(small, SF).collect()
    assert by_task(rows, "model") == {"regression": {("mean",), ("ridge",), ("gbt",)},
                                      "classification": {("logistic_balanced",), ("gbt_weighted",)}}
    for task, key, sign in (("regression", "mae", 1), ("classification", "f1", -1)):
        of = [r for r in rows if r.task == task]
        assert {r.model for r in of if r.best} == {r.model for r in of if sign * r[key] == min(sign * x[key] for x in of)}


def test_stacking_has_three_bases_a_task(small):
    models = {("stacking",), ("base_0",), ("base_1",), ("base_2",)}
    assert by_task(Q.m7(small, SF).collect(), "model") == {"regression": models, "classification": models}


def test_search_has_log_loss_and_an_encoder_per_fold(small, monkeypatch):
    fitted = []
    fit = Q.fit_encoder
    monkeypatch.setattr(Q, "fit_encoder", lambda train, spec: fitted.append(train.count()) or fit(train, spec))
    rows = Q.m8(small, SF).collect()
    assert {(r.task, r.metric, r.config) for r in rows} == {("regression", "mae", 0), ("classification", "log_loss", 0)}
    assert len(fitted) == 3 and fitted == sorted(set(fitted)) and all(r["mean"] > 0 for r in rows)


def test_noise_has_trees_and_classification(small):
    grid = {(m, c, v) for m in ("ridge", "gbt") for c in ("l_quantity", "l_discount") for v in (0.0, 0.5, 2.0)}
    assert by_task(Q.e10(small, SF).collect(), "model", "column", "level") == {
        "regression": grid, "classification": {("gbt_weighted", c, v) for m, c, v in grid}}


def test_drift_has_trees_and_classification(small):
    grid = {(m, t, s) for m in ("ridge", "gbt") for t in ("train60", "train70") for s in ("last40", "last30_no_overlap")}
    got = Q.e11(small, SF).collect()
    assert by_task(got, "model", "trained", "test_slice") == {
        "regression": grid, "classification": {("gbt_weighted", t, s) for m, t, s in grid}}
    assert all((r.n > min(x.n for x in got)) == (r.test_slice == "last40") for r in got)


def test_worst_cases_have_contributions(small):
    rows = Q.e15(small, SF).collect()
    own = [r for r in rows if r.centre_idx == r[Q.ROW_IDX]]
    d = Q.model_table(small, SF)
    mean = d.where("split = 'train'").agg({"y": "avg"}).first()[0]
    assert len(own) == 10
    for r in own:  # the mean of y plus all contributions is the prediction
        parts = [r[f"top{k}_contribution"] for k in range(1, len(Q.FEATS) + 1)]
        assert mean + sum(parts) == pytest.approx(r.prediction, abs=1e-2)
        x = d.where(f"{Q.ROW_IDX} = {r.centre_idx}").first() if r is own[0] else None
        assert x is None or all(r[f"top{k}_value"] == pytest.approx(x[r[f"top{k}_feature"]]) for k in range(1, len(Q.FEATS) + 1))


def test_contributions_have_dependence_and_devices(small):
    rows = Q.m13(small, SF).collect()
    kind = lambda k: [r for r in rows if r.kind == k]
    n = Q.model_table(small, SF).where("split = 'test'").count()
    assert len(kind("feature")) == len(Q.FEATS) and kind("feature")[0].max_identity_error < 1e-3
    assert len(kind("device")) == 5 * len(Q.FEATS) and len({r.l_suppkey for r in kind("device")}) == 5
    assert len(kind("dependence")) == n * 5
    for r in kind("feature"):  # the pairs add up to the summary
        parts = [abs(x.contribution) for x in kind("dependence") if x.feature == r.feature]
        assert sum(parts) / n == pytest.approx(r.mean_abs_contribution, rel=1e-3, abs=1e-3)


def test_scoring_makes_its_training_rows_once(spark, monkeypatch):
    made, d = spark.sparkContext.accumulator(0), Q.model_table(spark, SF).drop("features")

    def make(batches):
        for b in batches:
            made.add(len(b))
            yield b
    assemble = Q.VectorAssembler(inputCols=Q.FEATS, outputCol="features")
    monkeypatch.setattr(Q, "model_table", lambda *_: assemble.transform(d.mapInPandas(make, d.schema)))
    n = d.count()
    got = Q.m11(spark, SF)
    assert made.value == n
    assert got.count() == n and got.where("predicted_y is null or violation_probability is null").count() == 0
