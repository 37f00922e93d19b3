"""Equi-depth buckets of an ordering axis (density-robust partitioning).

Fixed-width time buckets collapse when the data are dense relative to the
bucket width (all rows inside one tolerance, or one stray timestamp that
stretches the axis). Equi-depth buckets hold about ``target_rows`` rows each
whatever the density: cut points are quantiles of the values, taken from a
mergeable sketch that every task fills over its rows (one pass, no shuffle of
rows). A bucket id is the number of cuts at or below the value, found by
binary search in a literal array, so rows are assigned where they lie.

Ids never fall as the value grows, and equal values always share a bucket:
only one value that carries more than ``target_rows`` rows makes a bucket
larger. The sketch's rank error is a quarter of a bucket, so a bucket holds at
most one and a half times its share besides that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BUCKETS = 1 << 16


class DepthBuckets:
    """Fitted cut points of one ordering axis (at most MAX_BUCKETS numbers)."""

    def __init__(self, cuts: list[int] | list[float]):
        self.cuts = cuts

    def id_of(self, t: Column) -> Column:
        n = len(self.cuts)
        cuts = F.lit(self.cuts)
        steps = F.lit([1 << k for k in range(n.bit_length() - 1, -1, -1)])
        found = F.reduce(steps, F.lit(0), lambda at, s: F.when(
            (at + s <= n) & (F.get(cuts, F.least(at + s, F.lit(n)) - 1) <= t), at + s).otherwise(at))
        return F.when(t.isNull(), F.lit(0)).otherwise(found)

    def assign(self, df: DataFrame, t_col: str, out: str) -> DataFrame:
        """Add the bucket id ``out`` of the ordering column ``t_col``."""
        return df.withColumn(out, self.id_of(F.col(t_col)))


def fit_depth_buckets(values: DataFrame, t_col: str, target_rows: int, max_buckets: int = MAX_BUCKETS) -> DepthBuckets:
    """Cut points for buckets of about ``target_rows`` (non-null) values."""
    kind = values.schema[t_col].dataType.simpleString()
    integral = kind in ("bigint", "int", "smallint", "tinyint")
    n = values.where(F.col(t_col).isNotNull()).count()
    k = min(max_buckets, -(-n // int(target_rows)))
    if k <= 1:
        # one cut all the same: a constant id would fold away and leave joins on it without a key
        return DepthBuckets([0 if integral else 0.0])
    got = values.select(F.col(t_col).cast("double").alias("t")).approxQuantile("t", [i / k for i in range(1, k)], 1 / (4 * k))
    return DepthBuckets(sorted({int(x) if integral else float(x) for x in got}))
