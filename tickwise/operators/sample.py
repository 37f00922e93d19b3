"""Exact-size sampling and seeded noise.

Exact stratified sample without replacement: targets are proportional with
half-even rounding, the residual goes to the largest stratum, and each target
is capped at its stratum size. Within a stratum rows are ranked by
``md5(seed || key)`` (same order in Spark and DuckDB, independent of
partitioning) and the first ``target`` rows are kept.

The ranking never puts a stratum in one task: a histogram of the first
``prefix_len`` hex digits of the hash per stratum (map-side combined) locates
the boundary bucket holding the target-th row; rows below it are kept
outright and only boundary-bucket rows (about ``stratum / 16^prefix_len``) are
ranked exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import strata_key
from ..session import checked_broadcast, cut_lineage
from .stats import attach_row

_H, _P, _S = "__smp_hash", "__smp_prefix", "__smp_stratum"


def sample_hash(key: str | Column, seed: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(str(seed)), k.cast("string")))


def stratum_targets(counts: DataFrame, n: int) -> DataFrame:
    """Per stratum ``target = min(bround(count / N * n) (+ residual if largest), count)``.
    ``counts`` has (stratum, count); one row per stratum (small)."""
    counts = cut_lineage(counts)  # one row per stratum, read by three aggregates
    c = attach_row(counts, counts.agg(F.sum("count").alias("__N")))
    c = c.withColumn("target", F.bround(F.col("count") / F.col("__N") * n, 0).cast("long"))
    # largest target wins the residual; ties -> larger count, then stratum key
    first = c.orderBy(F.col("target").desc(), F.col("count").desc(), F.col(_S).asc()).limit(1).select(F.col(_S).alias("__first"))
    c = attach_row(attach_row(c, c.agg((F.lit(n) - F.sum("target")).alias("__diff"))), first)
    c = c.withColumn("target", F.when(F.col(_S).eqNullSafe(F.col("__first")), F.col("target") + F.col("__diff")).otherwise(F.col("target")))
    return c.select(_S, "count", F.least(F.greatest(F.col("target"), F.lit(0)), F.col("count")).alias("target"))


def exact_sample_by_hash(df: DataFrame, stratum: Column, targets: DataFrame, key: str, seed: int,
                         prefix_len: int = 5) -> DataFrame:
    """Keep, per stratum, the ``target`` rows with the smallest ``(md5(seed||key), key)``."""
    x = df.withColumn(_S, stratum).withColumn(_H, sample_hash(key, seed))
    x = x.withColumn(_P, F.substring(_H, 1, prefix_len))
    hist = x.groupBy(_S, _P).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(_S).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("__before", F.coalesce(F.sum("__c").over(w), F.lit(0)))
    hist = hist.join(targets.select(_S, "target"), _S)
    bounds = hist.where((F.col("__before") < F.col("target"))
                        & (F.col("__before") + F.col("__c") >= F.col("target")))
    bounds = bounds.select(_S, F.col(_P).alias("__bp"), (F.col("target") - F.col("__before")).alias("__need"))
    # one row per stratum with a positive target
    x = x.join(checked_broadcast(bounds), _S, "inner")
    below = x.where(F.col(_P) < F.col("__bp"))
    edge = x.where(F.col(_P) == F.col("__bp"))
    edge = edge.withColumn("__r", F.row_number().over(
        Window.partitionBy(_S, _P).orderBy(_H, key))).where(F.col("__r") <= F.col("__need")).drop("__r")
    out = below.unionByName(edge)
    return out.drop(_H, _P, "__bp", "__need")


def stratified_sample(df: DataFrame, n: int, seed: int, strata: Sequence[str] | None, key: str,
                      *, prefix_len: int = 5, keep_stratum: bool = False) -> DataFrame:
    """T7 (falls back to T8 when no strata column is present)."""
    strata = [c for c in (strata or []) if c in df.columns]
    s = strata_key(strata) if strata else F.lit("")
    counts = df.groupBy(s.alias(_S)).agg(F.count(F.lit(1)).alias("count"))
    targets = stratum_targets(counts, n)
    out = exact_sample_by_hash(df, s, targets, key, seed, prefix_len)
    return out if keep_stratum else out.drop(_S)


def random_sample(df: DataFrame, n: int, seed: int, key: str, *, prefix_len: int = 5) -> DataFrame:
    """``min(n, N)`` rows, the smallest by ``md5(seed||key)`` (distributed, no top-n task)."""
    counts = df.groupBy(F.lit("").alias(_S)).agg(F.count(F.lit(1)).alias("count"))
    targets = counts.select(_S, "count", F.least(F.col("count"), F.lit(n)).cast("long").alias("target"))
    return exact_sample_by_hash(df, F.lit(""), targets, key, seed, prefix_len).drop(_S)


def _hashed_uniform(k: Column, seed: int, stream: int) -> Column:
    """52-bit integer from ``md5(seed|key|stream)`` (same value in DuckDB)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), k.cast("string"), F.lit(str(stream))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long")


def hashed_normal(key: str | Column, seed: int) -> Column:
    """N(0,1) from two hashed uniforms (Box-Muller): same value for a row
    whatever the partitioning or task retry, and reproducible in SQL."""
    k = F.col(key) if isinstance(key, str) else key
    two52 = float(1 << 52)
    u1 = (_hashed_uniform(k, seed, 1) + 1) / F.lit(two52 + 1)
    u2 = _hashed_uniform(k, seed, 2) / F.lit(two52)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(F.lit(2.0 * 3.141592653589793) * u2)


def inject_noise(df: DataFrame, col: str, scale: float, seed: int, key: str) -> DataFrame:
    """C14: ``x + N(0, scale * std_samp(x))``; sigma from one aggregate."""
    sigma = df.agg(F.stddev_samp(col)).first()[0] or 0.0
    return df.withColumn(col, F.col(col) + hashed_normal(key, seed) * F.lit(float(scale) * float(sigma)))
