"""Encoder and stacking as Spark ML stages.

``TabularEncoder`` and ``Stacking`` are Estimators whose Models are writable:
with ``RollingLagFeatures`` they stand in one ``Pipeline`` that takes raw rows
to scores, is fitted on train, saved as a ``PipelineModel`` and loaded again.
What an encoder has learnt about unbounded domains (frequency maps) is saved and
loaded as tables, never through the driver.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import EncoderSpec, TabularEncoderModel, fit_encoder
from .models import ridge


class _EncoderParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "columns to impute and standardise", TypeConverters.toListString)
    onehotCols = Param(Params._dummy(), "onehotCols", "columns with one output per category", TypeConverters.toListString)
    ordinalOrders = Param(Params._dummy(), "ordinalOrders", "JSON: column to its ordered categories", TypeConverters.toString)
    frequencyCols = Param(Params._dummy(), "frequencyCols", "columns encoded by their share", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled features", TypeConverters.toString)

    def spec(self) -> EncoderSpec:
        get = self.getOrDefault
        return EncoderSpec(get(self.numericCols), get(self.onehotCols), json.loads(get(self.ordinalOrders)), get(self.frequencyCols))


class TabularEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits every block of the encoder on the rows it is given."""

    def __init__(self, numeric: Sequence[str] = (), onehot: Sequence[str] = (), ordinal: Mapping[str, Sequence[str]] | None = None,
                 frequency: Sequence[str] = (), output_col: str = "features"):
        super().__init__()
        self._set(numericCols=list(numeric), onehotCols=list(onehot), ordinalOrders=json.dumps({k: list(v) for k, v in (ordinal or {}).items()}),
                  frequencyCols=list(frequency), outputCol=output_col)

    def _fit(self, df: DataFrame) -> "TabularEncoderStage":
        return self._copyValues(TabularEncoderStage(fit_encoder(df, self.spec())))


class TabularEncoderStage(Model, _EncoderParams, MLReadable, MLWritable):
    """A fitted encoder: adds the features to the columns of its input."""

    def __init__(self, encoder: TabularEncoderModel | None = None):
        super().__init__()
        self.encoder = encoder

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.getOrDefault(self.outputCol)
        got = self.encoder.transform(df, keep=[c for c in df.columns if c != out], assemble=out)
        return got.select(*[c for c in df.columns if c != out], out)

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


class _EncoderWriter(MLWriter):
    def __init__(self, instance: TabularEncoderStage):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.encoder.save(os.path.join(path, "data"))


class _EncoderReader(MLReader):
    def load(self, path: str) -> TabularEncoderStage:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = TabularEncoderStage(TabularEncoderModel.load(self.sparkSession, os.path.join(path, "data")))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _StackingParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    heldOutCol = Param(Params._dummy(), "heldOutCol", "whether the meta learner, not the bases, learns from a row", TypeConverters.toString)
    classification = Param(Params._dummy(), "classification", "two classes, or a number", TypeConverters.toBoolean)

    def base_scores(self, df: DataFrame, bases: Sequence[Model]) -> DataFrame:
        """``df`` with base_0, base_1 ... and their vector ``meta_features``."""
        score = vector_to_array("probability")[1] if self.getOrDefault(self.classification) else F.col("prediction")
        out = df
        for i, base in enumerate(bases):
            out = base.transform(out).select(*out.columns, score.alias(f"base_{i}"))
        return VectorAssembler(inputCols=[f"base_{i}" for i in range(len(bases))], outputCol="meta_features").transform(out)


class Stacking(Estimator, _StackingParams):
    """Bases learn from the rows that are not held out, a ridge or logistic meta
    learner from the bases' scores of those that are."""

    def __init__(self, bases: Sequence[Estimator], label_col: str, held_out_col: str, classification: bool = False):
        super().__init__()
        self.bases = list(bases)
        self._set(labelCol=label_col, heldOutCol=held_out_col, classification=classification)

    def _fit(self, df: DataFrame) -> "StackingModel":
        label, held = self.getOrDefault(self.labelCol), F.col(self.getOrDefault(self.heldOutCol)).cast("boolean")
        # every base reads the rows that learn, the meta learner the others: one pass makes both
        rows = df.persist(StorageLevel.MEMORY_AND_DISK) if df.storageLevel == StorageLevel.NONE else df
        try:
            bases = [b.fit(rows.where(~held)) for b in self.bases]
            rest = self.base_scores(rows.where(held), bases).select(label, "meta_features").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if self.getOrDefault(self.classification):
                    meta = LogisticRegression(featuresCol="meta_features", labelCol=label, maxIter=1000, regParam=1.0 / max(rest.count(), 1),
                                              standardization=False).fit(rest)
                else:
                    meta = ridge(rest, "meta_features", label)
            finally:
                rest.unpersist()
        finally:
            if rows is not df:
                rows.unpersist()
        return self._copyValues(StackingModel(bases, meta))


class StackingModel(Model, _StackingParams, MLReadable, MLWritable):
    """Fitted bases and meta learner: adds the meta learner's columns."""

    def __init__(self, bases: Sequence[Model] = (), meta: Model | None = None):
        super().__init__()
        self.bases, self.meta = list(bases), meta

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.meta.transform(self.base_scores(df, self.bases))

    def write(self) -> MLWriter:
        return _StackingWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StackingReader()


class _StackingWriter(MLWriter):
    def __init__(self, instance: StackingModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"bases": len(self.instance.bases)})
        for name, model in [*((f"base_{i}", b) for i, b in enumerate(self.instance.bases)), ("meta", self.instance.meta)]:
            model.write().save(os.path.join(path, name))


class _StackingReader(MLReader):
    def load(self, path: str) -> StackingModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        load = lambda name: DefaultParamsReader.loadParamsInstance(os.path.join(path, name), self.sparkSession)
        stage = StackingModel([load(f"base_{i}") for i in range(metadata["bases"])], load("meta"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
