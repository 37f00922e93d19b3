"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node of
    ``edges`` (long ids; direction, repeats, loops and nulls don't matter).

    Each round hangs every neighbour of a node below the smallest one (large
    star), then every smaller neighbour too (small star); a logarithmic number
    of rounds turns each component into a star around its smallest node. Only
    minima are aggregated (partial sums before the shuffle), neighbour lists
    are never gathered, so a node with very many edges costs no task more than
    its share. A round is written to the shared checkpoint folder."""
    u, v = F.col(f"`{a}`").cast("long"), F.col(f"`{b}`").cast("long")
    e = materialise(edges.where(u.isNotNull() & v.isNotNull() & (u != v))
                    .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    while True:
        # stars: a node that hangs below another hangs below one only, and nothing hangs below it
        ends = F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
                                F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))))
        ends = e.select(ends).groupBy("node").agg(F.sum("below").alias("below"), F.sum("above").alias("above"))
        if not ends.where("below > 1 or below = 1 and above > 0").limit(1).count():
            break
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
    # every edge now runs from a node to the centre of its star
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
