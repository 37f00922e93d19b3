"""Fit/transform feature encoders with scikit-learn parity.

* F1 median impute: exact interpolated median by distributed selection
  (``ml.Imputer`` is approximate, ``percentile`` gathers a whole column in one
  task); columns that are all null in the fit data are dropped.
* F2 standardise with the *population* std; zero variance -> scale 1.
* F3/F4 one-hot: nulls -> ``__MISSING__``; categories sorted; unknown -> all
  zeros; a column with exactly two categories keeps only the second.
* F5 ordinal with explicit orders; the fill is ``Normal`` for every column (a
  reference quirk kept on purpose); unknown -> -1.
* F6 frequency: share among non-null fit rows; unseen / null -> 0. The maps
  stay DataFrames (they grow with the key domain) and are joined with a
  size-checked broadcast.

Fitting costs: three passes for medians, one for mean/std of the imputed
values, one for the categorical domains (collected: categorical domains are
small by construction), one grouped count per frequency column, all over the
columns in use.
Transforming is one projection (codegen) plus the frequency joins.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded_values, checked_broadcast, cut_lineage, scan_only

MAX_CATEGORIES = 2000
MISSING = "__MISSING__"
ORDINAL_FILL = "Normal"


@dataclass
class EncoderSpec:
    numeric: Sequence[str] = ()
    onehot: Sequence[str] = ()
    ordinal: Mapping[str, Sequence[str]] = field(default_factory=dict)
    frequency: Sequence[str] = ()


def _number(c: str) -> Column:
    """The column as double with NaN as null: a missing value either way."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


@dataclass
class TabularEncoderModel:
    """Fitted encoder. ``freq_maps`` are DataFrames (col -> (value, share))."""
    spec: EncoderSpec
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    categories: dict[str, list[str]]
    freq_maps: dict[str, DataFrame]

    # F8
    def feature_names(self) -> list[str]:
        names = [f"num__{c}" for c in self.medians]
        for c, cats in self.categories.items():
            names += [f"onehot__{c}_{v}" for v in _kept(cats)]
        names += [f"ordinal__{c}" for c in self.spec.ordinal]
        names += [f"freq__{c}_freq" for c in self.spec.frequency]
        return names

    def transform(self, df: DataFrame, keep: Sequence[str] = (), assemble: str | None = None) -> DataFrame:
        exprs = [F.col(k) for k in keep]
        for c, med in self.medians.items():
            x = F.coalesce(_number(c), F.lit(med))
            exprs.append(((x - F.lit(self.means[c])) / F.lit(self.scales[c])).alias(f"num__{c}"))
        for c, cats in self.categories.items():
            v = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
            for cat in _kept(cats):
                exprs.append(F.when(v == cat, 1.0).otherwise(0.0).alias(f"onehot__{c}_{cat}"))
        for c, order in self.spec.ordinal.items():
            m = F.create_map(*[x for i, cat in enumerate(order) for x in (F.lit(cat), F.lit(float(i)))])
            v = F.coalesce(F.col(c).cast("string"), F.lit(ORDINAL_FILL))
            exprs.append(F.coalesce(m[v], F.lit(-1.0)).alias(f"ordinal__{c}"))
        fcols = list(self.spec.frequency)
        out = df.select(*exprs, *[F.col(c).alias(f"__fq_{c}") for c in fcols])
        for c in fcols:
            fm = checked_broadcast(self.freq_maps[c].select(F.col("value").alias(f"__fv_{c}"),
                                                            F.col("share").alias(f"freq__{c}_freq")))
            out = out.join(fm, F.col(f"__fq_{c}").cast("string") == F.col(f"__fv_{c}"), "left").drop(f"__fv_{c}")
            out = out.withColumn(f"freq__{c}_freq", F.coalesce(F.col(f"freq__{c}_freq"), F.lit(0.0)))
        out = out.drop(*[f"__fq_{c}" for c in fcols])
        if assemble:
            out = VectorAssembler(inputCols=self.feature_names(), outputCol=assemble,
                                  handleInvalid="keep").transform(out)
        return out

    # persistence
    def save(self, path: str) -> None:
        spark = next(iter(self.freq_maps.values())).sparkSession if self.freq_maps else \
            SparkSession.getActiveSession()
        meta = {"numeric": list(self.spec.numeric), "onehot": list(self.spec.onehot),
                "ordinal": {k: list(v) for k, v in self.spec.ordinal.items()},
                "frequency": list(self.spec.frequency), "medians": self.medians, "means": self.means,
                "scales": self.scales, "categories": self.categories}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite").text(os.path.join(path, "meta"))
        for c, fm in self.freq_maps.items():
            fm.write.mode("overwrite").parquet(os.path.join(path, f"freq_{c}"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TabularEncoderModel":
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
        spec = EncoderSpec(meta["numeric"], meta["onehot"], meta["ordinal"], meta["frequency"])
        fms = {c: spark.read.parquet(os.path.join(path, f"freq_{c}")) for c in spec.frequency}
        return TabularEncoderModel(spec, meta["medians"], meta["means"], meta["scales"],
                                   meta["categories"], fms)


def _kept(cats: list[str]) -> list[str]:
    """``drop='if_binary'``: two categories keep only the second."""
    return cats[1:] if len(cats) == 2 else cats


def fit_encoder(train: DataFrame, spec: EncoderSpec) -> TabularEncoderModel:
    """Fit every block on ``train``. Every block reads the rows again, so
    more than a scan of them is held (in the block store, which spills) meanwhile."""
    if scan_only(train):
        return _fit_blocks(train, spec)
    used = {*spec.numeric, *spec.onehot, *spec.frequency}
    rows = train.select(*[f"`{c}`" for c in train.columns if c in used]) if used <= set(train.columns) else train
    if rows.storageLevel != StorageLevel.NONE:
        return _fit_blocks(rows, spec)
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_blocks(held, spec)
    finally:
        held.unpersist()


def _fit_blocks(train: DataFrame, spec: EncoderSpec) -> TabularEncoderModel:
    num = list(spec.numeric)
    medians, means, scales = {}, {}, {}
    if num:
        from .stats import column_quantiles
        got = column_quantiles(train, num, 0.5)
        medians = {c: float(got[c]) for c in num if got.get(c) is not None}
        kept = list(medians)
        if kept:
            imp = {c: F.coalesce(_number(c), F.lit(medians[c])) for c in kept}
            row = train.agg(*[F.avg(e).alias(f"a{i}") for i, e in enumerate(imp.values())],
                            *[F.stddev_pop(e).alias(f"s{i}") for i, e in enumerate(imp.values())]).first()
            for i, c in enumerate(kept):
                means[c] = float(row[f"a{i}"])
                sd = row[f"s{i}"]
                scales[c] = float(sd) if sd not in (None, 0.0) and sd > 0 else 1.0
    categories = {}
    if spec.onehot:
        doms = train.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("v"))
            for c in spec.onehot])).alias("s")).select("s.*").distinct()
        # every category becomes a column, so the domains are bounded by what a plan can hold
        doms = bounded_values(doms, MAX_CATEGORIES * len(spec.onehot), f"one-hot domains of {list(spec.onehot)}")
        for c in spec.onehot:
            categories[c] = sorted(r["v"] for r in doms if r["c"] == c)
    # written once: the fitted maps must not go back to the rows at every use
    freq_maps = {c: cut_lineage(frequency_map(train, c)) for c in spec.frequency}
    return TabularEncoderModel(spec, medians, means, scales, categories, freq_maps)


def frequency_map(df: DataFrame, col: str) -> DataFrame:
    """F6 fit: ``value_counts(normalize=True)`` as (value string, share)."""
    g = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    tot = g.agg(F.sum("n").alias("tot"))
    return (g.withColumn("__one", F.lit(1)).join(F.broadcast(tot.withColumn("__one", F.lit(1))), "__one")
             .select("value", (F.col("n") / F.col("tot")).alias("share")))
