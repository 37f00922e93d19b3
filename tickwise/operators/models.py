"""Model training and scoring on Spark ML.

Parity rules established in SURVEY §2.10 / §4.3:

* Ridge (alpha, intercept unpenalised): ``LinearRegression(solver="normal",
  elasticNetParam=0, standardization=False, regParam=alpha*std_pop(y)/n)``.
* Balanced logistic: class weights ``n / (2 n_c)``, ``regParam = 1/(C*sum w)``,
  ``standardization=False``.
* L2 logistic (propensity): ``regParam = 1/(C*n)``.
* Boosted trees: ``GBTRegressor`` / ``GBTClassifier`` models; early stopping uses
  ``evaluateEachIteration`` on validation with a patience rule, then refits
  unless the best count is the one fitted. A level of a tree is a job of its
  own, so small training rows stand in few partitions (``packed``).
* Boosted trees learn from binned rows (``boosting``), made once for all fits on
  the same rows (``cells``); Spark's own fit is left for categorical features.
* Independent fits run side by side (``side_by_side``), as the ``parallelism``
  of Spark's CrossValidator: a round of boosting is a chain of short jobs.

Training data never leaves the cluster; only fitted coefficients/trees
(bounded by the feature count and iteration count) reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .boosting import Cells, boost, categorical, cells, class_rows, subset

#: Fits that run at once; each holds its training rows in the block store, which spills.
SIDE_BY_SIDE = 4


def side_by_side(spark, fits: Sequence[Callable[[], object]], parallelism: int = SIDE_BY_SIDE) -> list:
    """Results of independent ``fits``, in their order."""
    if not fits:
        return []
    with ThreadPool(min(parallelism, len(fits))) as pool:
        return pool.map(lambda fit: inheritable_thread_target(spark)(fit)(), fits, chunksize=1)


# M1
def mean_predictor(train: DataFrame, label: str) -> float:
    return float(train.agg(F.avg(label)).first()[0])


def predict_constant(df: DataFrame, value: float, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.lit(float(value)))


# M2
def ridge(train: DataFrame, features: str, label: str, alpha: float = 1.0):
    n, sd = train.agg(F.count(label), F.stddev_pop(label)).first()
    reg = float(alpha) * float(sd or 0.0) / max(int(n), 1)
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal", elasticNetParam=0.0,
                            standardization=False, regParam=reg).fit(train)


# M3
#: Training rows of a boosted model that a task goes through.
TASK_ROWS = 250_000


def packed(train: DataFrame) -> DataFrame:
    """``train`` in no more partitions than there are cores, or one per
    ``TASK_ROWS`` rows if those are more: boosting makes two stages a level."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.coalesce(max(cores, -(-train.count() // TASK_ROWS)))


def _left_to_spark(train: DataFrame, features: str, feature_subset: str) -> bool:
    """Trees over categories, and subsets of features that have a name."""
    return categorical(train, features) or subset(feature_subset, 1) is None


def gbt_regressor(train: DataFrame | Cells, features: str, label: str, *, max_iter: int = 200, max_depth: int = 6,
                  step: float = 0.1, subsample: float = 1.0, feature_subset: str = "all", seed: int = 42):
    est = GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                       stepSize=step, subsamplingRate=subsample, featureSubsetStrategy=feature_subset, seed=seed)
    if isinstance(train, DataFrame):
        if _left_to_spark(train, features, feature_subset):
            return est.fit(packed(train))
        train = cells(train, features, target=label, added=subsample == 1.0)
    return boost(est, train)


def class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """(``label``, weight, rows) per class. Written once: a fit goes over its rows
    several times, and counting them must not be part of each."""
    counts = cut_lineage(df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc")))
    tot = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = counts.withColumn("__one", F.lit(1)).join(F.broadcast(tot.withColumn("__one", F.lit(1))), "__one")
    return cut_lineage(w.select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(out), "__nc"))


def balanced_weights(df: DataFrame, label: str, out: str = "class_weight", weights: DataFrame | None = None) -> DataFrame:
    """``class_weight='balanced'``: ``n / (n_classes * n_c)`` per row."""
    w = class_weights(df, label, out) if weights is None else weights
    return df.join(F.broadcast(w.drop("__nc")), label, "left")


# M4
def balanced_logistic(train: DataFrame, features: str, label: str, C: float = 1.0, max_iter: int = 1000):
    w = class_weights(train, label)
    tw = balanced_weights(train, label, weights=w)
    # the weights of all rows; rows without a label match no class
    sw = float(w.where(F.col(label).isNotNull()).agg(F.sum(F.col("class_weight") * F.col("__nc"))).first()[0])
    return LogisticRegression(featuresCol=features, labelCol=label, weightCol="class_weight",
                              regParam=1.0 / (C * sw), elasticNetParam=0.0, standardization=False,
                              maxIter=max_iter, tol=1e-10).fit(tw)


# M5
def gbt_classifier(train: DataFrame | Cells, features: str, label: str, *, max_iter: int = 200, max_depth: int = 6,
                   step: float = 0.1, subsample: float = 1.0, feature_subset: str = "all", weighted: bool = True,
                   seed: int = 42):
    est = GBTClassifier(featuresCol=features, labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, subsamplingRate=subsample, featureSubsetStrategy=feature_subset, seed=seed)
    if isinstance(train, DataFrame):
        if _left_to_spark(train, features, feature_subset):
            data = packed(train)
            data = balanced_weights(data, label) if weighted else data
            return (est.setWeightCol("class_weight") if weighted else est).fit(data)
        train = cells(train, features, classes=label, added=subsample == 1.0)
    if not weighted:
        return boost(est, train)
    rows = class_rows(train)
    there = sum(n > 0 for n in rows)
    return boost(est, train, tuple(train.n / (there * n) if n else 1.0 for n in rows))


# M9
def propensity_scores(df: DataFrame, features: str, treat: str, C: float = 1.0, out: str = "propensity"):
    n = df.count()
    lr = LogisticRegression(featuresCol=features, labelCol=treat, regParam=1.0 / (C * n),
                            elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-10)
    m = lr.fit(df)
    return m.transform(df).withColumn(out, vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction")


# M6
@dataclass
class EarlyStopResult:
    best_iter: int
    history: list[float]
    model: object


def early_stopping_gbt(train: DataFrame | Cells, val: DataFrame, features: str, label: str, *, classification: bool,
                       max_rounds: int = 500, patience: int = 30, max_depth: int = 6, step: float = 0.1,
                       seed: int = 42) -> EarlyStopResult:
    """Fit ``max_rounds`` trees once, score every prefix on validation
    (``evaluateEachIteration``), stop at the first run of ``patience`` rounds
    without improvement, refit with the best count (the same model, if that is
    ``max_rounds``)."""
    if isinstance(train, DataFrame) and not categorical(train, features):
        train = cells(train, features, **{"classes" if classification else "target": label})

    def fit(rounds: int):
        how = {"max_iter": rounds, "max_depth": max_depth, "step": step, "seed": seed}
        if classification:
            return gbt_classifier(train, features, label, weighted=False, **how)
        return gbt_regressor(train, features, label, **how)

    full = fit(max_rounds)
    hist = list(full.evaluateEachIteration(val) if classification else full.evaluateEachIteration(val, "squared"))
    best, best_i, since = float("inf"), 0, 0
    for i, v in enumerate(hist):
        if v < best:
            best, best_i, since = v, i, 0
        else:
            since += 1
            if since >= patience:
                break
    k = best_i + 1
    model = full if k == max_rounds else fit(k)
    return EarlyStopResult(k, hist, model)


# M7
def stacking(train: DataFrame, val: DataFrame, features: str, label: str, base_models: Sequence,
             *, classification: bool):
    """Bases fitted on train; meta learner (ridge / logistic) fitted on the
    bases' validation predictions. Returns (bases, meta, score_fn)."""
    def base_cols(df):
        out = df
        for i, m in enumerate(base_models):
            pred = m.transform(out)
            col = (vector_to_array("probability")[1] if classification else F.col("prediction"))
            keep = [c for c in out.columns]
            out = pred.select(*keep, col.alias(f"base_{i}"))
        return out
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=[f"base_{i}" for i in range(len(base_models))], outputCol="meta_features")
    vb = va.transform(base_cols(val))
    meta = (LogisticRegression(featuresCol="meta_features", labelCol=label, maxIter=1000,
                               regParam=1.0 / max(vb.count(), 1), standardization=False).fit(vb)
            if classification else ridge(vb, "meta_features", label))

    def score(df: DataFrame) -> DataFrame:
        return meta.transform(va.transform(base_cols(df)))
    return meta, score


# M10
def flatten_sequences(df: DataFrame, seq_col: str = "seq", out: str = "features") -> DataFrame:
    """Sequence windows (array<double> or array<array<double>>) -> one vector."""
    dt = df.schema[seq_col].dataType.simpleString()
    flat = F.flatten(seq_col) if dt.startswith("array<array") else F.col(seq_col)
    return df.withColumn(out, array_to_vector(flat))


# M12
def feature_importances(spark, model, names: Sequence[str], top: int = 20) -> DataFrame:
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature").limit(top)


# S12
def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_pipeline(stages: list, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(train)
