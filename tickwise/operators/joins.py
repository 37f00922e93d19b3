"""Equi-joins used to assemble the combined table.

* Left-wins collisions (P2): right columns already present on the left are
  dropped before the join instead of suffixing and dropping afterwards.
* Keep-first dedupe (P9) is an aggregate (``min_by`` over a struct), so it is
  partially aggregated map-side and a hot key never lands whole in one task.
* Dimension sides are broadcast only behind a row-count bound
  (``checked_broadcast``); above it the join is a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import DEFAULT_BROADCAST_ROWS, checked_broadcast


def _as_list(x: Sequence[str] | str) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def drop_suffixed(df: DataFrame, suffix: str = "_dup") -> DataFrame:
    """Drop every column whose name ends with ``suffix``."""
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def rename_collisions(df: DataFrame, cols: Sequence[str], suffix: str) -> DataFrame:
    """Keep-both collision rename ``c`` -> ``c{suffix}`` for the given columns."""
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in cols if c in df.columns})


def keep_first(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order`` (must make rows unique).

    ``min_by`` is a partial aggregate: each task reduces its rows per key
    before the shuffle, so the shuffle carries one row per (task, key).
    """
    keys = _as_list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("__first"))
              .select(*keys, *[F.col(f"__first.{c}").alias(c) for c in rest]))


def left_join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str | None = None,
    *,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Left join fact -> dimension; left columns win collisions.

    Duplicate dimension keys fan out (the reference does not dedupe here; use
    ``keep_first`` first for J2). The dimension key is renamed to the fact key
    (P1) and only one copy is kept. ``null_safe`` matches null keys to null keys
    as pandas does.
    """
    dim_key = dim_key or fact_key
    keep = [c for c in dim.columns if c != dim_key and c not in fact.columns]
    d = dim.select(F.col(dim_key).alias("__dim_key"), *keep)
    d = checked_broadcast(d, max_broadcast_rows)
    cond = (F.col(fact_key).eqNullSafe(F.col("__dim_key")) if null_safe
            else F.col(fact_key) == F.col("__dim_key"))
    return fact.join(d, cond, "left").drop("__dim_key")


def left_join_first(
    fact: DataFrame,
    other: DataFrame,
    key: str,
    order: Sequence[str | Column],
    *,
    other_key: str | None = None,
    null_safe: bool = False,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Dedupe ``other`` keep-first per key, then left join."""
    other_key = other_key or key
    first = keep_first(other, other_key, order)
    return left_join_dimension(fact, first, key, other_key, null_safe=null_safe,
                               max_broadcast_rows=max_broadcast_rows)


def lookup(df: DataFrame, col: str, mapping: DataFrame, key: str, value: str,
           out: str, default=None, *, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``Series.map(dict).fillna(default)`` as a left join on a
    (size-checked) broadcast lookup table."""
    m = checked_broadcast(mapping.select(F.col(key).alias("__lk"), F.col(value).alias("__lv")),
                          max_broadcast_rows)
    res = df.join(m, F.col(col) == F.col("__lk"), "left").drop("__lk")
    val = F.col("__lv") if default is None else F.coalesce(F.col("__lv"), F.lit(default))
    return res.withColumn(out, val).drop("__lv")
