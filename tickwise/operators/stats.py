"""Aggregations and statistics.

Everything is a grouped aggregate with partial (map-side) aggregation. Exact
percentiles use ``percentile`` (linear interpolation, same as NumPy and DuckDB
``quantile_cont``), never ``approx_percentile``. Bootstraps compute the
weighted sums per replicate inside each task (``mapInPandas`` + NumPy) and
shuffle only ``tasks x replicates`` partial sums.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dist import student_t_two_sided_p
from ..functions.hashing import poisson1_weights
from ..session import bounded_values, checked_broadcast, cut_lineage

CHUNK_ROWS = 2048
CHUNK_CELLS = 1 << 17   # rows x replicates of bootstrap weights that a task makes at once
HELD_SUMS = 8_000_000   # doubles of bootstrap sums that a task holds


def num(c: str) -> Column:
    """Column as double with NaN read as missing (pandas semantics)."""
    x = F.col(c).cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row (broadcast
    join on a constant key; the right side has exactly one row)."""
    return (df.withColumn("__one", F.lit(1))
              .join(F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one").drop("__one"))


# ---------------------------------------------------------------- quantiles
def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    prefix: str = "q") -> DataFrame:
    """Exact linearly interpolated quantiles (NumPy default / ``quantile_cont``)
    of non-null ``value`` per group, one row per group with columns
    ``{prefix}0, {prefix}1, ...`` in ``probs`` order.

    Distributed: rows are first added up to (group, value, count), so a value
    that many rows share is one row; running counts per group
    (``order.cumulative_sums``, range partitioned on (group, value)) tell which
    positions a value covers; one grouped aggregate picks the two values around
    each quantile. No task ever holds a whole group (``percentile`` would).
    """
    from .order import cumulative_sums
    by = list(by)
    x = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        *by, F.col(value).cast("double").alias("__v"))
    counts = x.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__c"))
    cum = cut_lineage(cumulative_sums(counts, ["__v"], ["__c"], partition_by=by))
    n = cum.groupBy(*by).agg(F.sum("__c").alias("__n"))
    j = cum.join(checked_broadcast(n), by) if by else attach_row(cum, n)
    first, end = F.col("__c_cum") - F.col("__c"), F.col("__c_cum")
    aggs = []
    for i, q in enumerate(probs):
        h = (F.col("__n") - 1) * F.lit(float(q))
        for name, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((first <= at) & (at < end), F.col("__v"))).alias(f"__{name}{i}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"__f{i}"))
    got = j.groupBy(*by).agg(*aggs)
    return got.select(*by, *[(F.col(f"__lo{i}") + F.col(f"__f{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(f"{prefix}{i}")
                             for i in range(len(probs))])


#: Rank error of the sketch that brackets a quantile is at most rows / SKETCH. One
#: task merges the sketches of all partitions, so they are kept small.
SKETCH = 1_000


def column_quantiles(df: DataFrame, cols: Sequence[str], q: float, few: int = 100 * SKETCH) -> dict[str, float | None]:
    """Exact linearly interpolated quantile ``q`` of each column's non-null values
    (None without any), equal to ``exact_quantiles``, for columns side by side.

    A sketch gives two bounds around each quantile, one count the values below
    them; only values between the bounds (about 8 in ``SKETCH``, all of columns
    with at most ``few``) are added up, sorted and searched. Ranks are checked: a
    column whose quantile isn't between its bounds is searched whole.
    """
    from .order import cumulative_sums
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    x = df.select(*[num(c).alias(f"v{i}") for i, c in enumerate(cols)])
    near = [min(max(q + side * 4 / SKETCH, 0.0), 1.0) for side in (-1, 1)]
    seen = x.agg(*[a for i in range(len(cols)) for a in (
        F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", near, SKETCH).alias(f"b{i}"))]).first()
    ns = {i: seen[f"n{i}"] for i in range(len(cols)) if seen[f"n{i}"]}
    bounds = {i: (float("-inf"), float("inf")) if n <= few else tuple(seen[f"b{i}"]) for i, n in ns.items()}
    got = {}
    while len(got) < len(ns):
        todo = [i for i in ns if i not in got]
        at = {i: (ns[i] - 1) * float(q) for i in todo}
        inside = {i: F.col(f"v{i}").between(F.lit(bounds[i][0]), F.lit(bounds[i][1])) for i in todo}
        under = x.agg(*[F.count(F.when(F.col(f"v{i}") < F.lit(bounds[i][0]), 1)).alias(f"u{i}") for i in todo]).first()
        some = x.where(reduce(lambda a, b: a | b, inside.values())).select(F.explode(F.array(*[
            F.when(inside[i], F.struct(F.lit(i).alias("column"), F.col(f"v{i}").alias("v"))) for i in todo])).alias("s"))
        counts = some.where(F.col("s").isNotNull()).select("s.*").groupBy("column", "v").agg(F.count(F.lit(1)).alias("c"))
        cum = cumulative_sums(counts, ["v"], ["c"], partition_by=["column"])
        start = reduce(lambda e, i: e.when(F.col("column") == i, under[f"u{i}"]), todo, F.when(F.lit(False), F.lit(0)))
        cum = cum.select("column", "v", (start + F.col("c_cum") - F.col("c")).alias("first"), (start + F.col("c_cum")).alias("end"))
        holds = [(F.col("column") == i) & (F.col("first") <= r) & (F.col("end") > r)
                 for i in todo for r in sorted({math.floor(at[i]), math.ceil(at[i])})]
        rows = cum.where(reduce(lambda a, b: a | b, holds)).collect()  # at most two rows a column
        for i in todo:
            ends = [next((r["v"] for r in rows if r["column"] == i and r["first"] <= k < r["end"]), None)
                    for k in (math.floor(at[i]), math.ceil(at[i]))]
            if None in ends:
                if bounds[i] == (float("-inf"), float("inf")):
                    raise AssertionError(f"no value at rank {at[i]} of {cols[i]}")
                bounds[i] = (float("-inf"), float("inf"))
            else:
                got[i] = ends[0] + (at[i] - math.floor(at[i])) * (ends[1] - ends[0])
    return {c: got.get(i) for i, c in enumerate(cols)}


def _quantile_cols(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], names: Sequence[str]):
    q = exact_quantiles(df, value, probs, by)
    return q.select(*by, *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])


# ---------------------------------------------------------------- profiling
def missing_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: per column missing count and percent (2 dp), most missing first (ties
    in column order); ``position`` tells the order. NaN counts as missing."""
    cols = list(cols or df.columns)
    num = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def miss(c):
        m = F.col(c).isNull()
        return (m | F.isnan(c)) if c in num else m
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(miss(c).cast("long")).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = F.posexplode(F.array_sort(F.array(*[
        F.struct((-F.col(f"m{i}")).alias("less"), F.lit(i).alias("i"), F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
        for i, c in enumerate(cols)])))
    out = row.select("__n", stack.alias("position", "s")).select(
        "position", "s.column", "s.missing",
        F.round(F.col("s.missing") / F.col("__n") * 100, 2).alias("pct"))
    return out


def profile(df: DataFrame, table: str) -> DataFrame:
    """A2: rows, columns, and per column dtype / missing / non-null (long form)."""
    ms = missing_summary(df)
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return (ms.join(F.broadcast(types), "column")
              .transform(lambda d: attach_row(d, n))
              .select(F.lit(table).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
                      "column", "dtype", "missing",
                      (F.col("n_rows") - F.col("missing")).alias("non_null")))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A3: distinct non-null values per column (``approx`` = HyperLogLog++)."""
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    row = df.agg(*[f(c).alias(f"d{i}") for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"d{i}").cast("long").alias("n_distinct"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: min / max / median / mean of non-null values per column."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}"), F.avg(c).alias(f"av{i}")]
    row = df.agg(*aggs)
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"mn{i}").cast("double").alias("min"),
                 F.col(f"mx{i}").cast("double").alias("max"), F.col(f"av{i}").alias("mean"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    med = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                        for c in cols])).alias("s")).select("s.*")
    med = _quantile_cols(med, "v", [0.5], ["column"], ["median"])
    return long.join(med, "column", "left").select("column", "min", "max", "median", "mean")


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A5: count, mean, sample std, min, 25/50/75 % (interpolated), max.
    All columns are stacked into (group, column, value) once, so one
    aggregate and one quantile pass serve every column."""
    by = list(by)
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")
    ).select(*by, "s.column", "s.v")
    g = long.groupBy(*by, "column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = _quantile_cols(long, "v", [0.25, 0.5, 0.75], [*by, "column"], ["p25", "p50", "p75"])
    return g.join(q, [*by, "column"], "left").select(*by, "column", "count", "mean", "std", "min",
                                                     "p25", "p50", "p75", "max")


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Count per non-null value (and share of non-null rows)."""
    x = df.where(F.col(col).isNotNull())
    g = x.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:  # one number beside the counts: no task holds all values
        g = attach_row(g, x.agg(F.count(F.lit(1)).alias("__all"))).withColumn("share", F.col("count") / F.col("__all")).drop("__all")
    return g


def most_frequent(df: DataFrame, col: str) -> DataFrame:
    """The most frequent non-null key (ties -> smallest key), one row."""
    return top_k_by_count(df, col, 1)


def top_k_by_count(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` keys with most rows (ties -> smaller key)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col(col).asc()).limit(k))


def group_mean(df: DataFrame, key: str | Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Mean per group; null groups dropped (pandas ``groupby`` default)."""
    keys = [key] if isinstance(key, str) else list(key)
    x = df
    for k in keys:
        x = x.where(F.col(k).isNotNull())
    return x.groupBy(*keys).agg(F.avg(value).alias(name or f"mean_{value}"))


def named_agg(df: DataFrame, by: Sequence[str], aggs: Mapping[str, Column], dropna: bool = True) -> DataFrame:
    """``groupby(by).agg(name=(col, fn))`` for one or more keys."""
    x = df
    if dropna:
        for k in by:
            x = x.where(F.col(k).isNotNull())
    return x.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])


def pivot_mean(df: DataFrame, index: str, columns: str, value: str, max_columns: int = 1000) -> DataFrame:
    """``pivot_table(aggfunc='mean')``. Column values become columns of the
    plan; more than ``max_columns`` of them is an error."""
    found = df.where(F.col(columns).isNotNull()).select(columns).distinct()
    vals = sorted(r[0] for r in bounded_values(found, max_columns, f"pivot of {columns}"))
    return df.where(F.col(index).isNotNull()).groupBy(index).pivot(columns, vals).agg(F.avg(value))


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation per column pair with pairwise-complete rows
    (``corr`` skips rows where either side is null). Long form (a, b, r),
    a < b in column order; one aggregate job for all pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(num(a), num(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])).alias("s")).select("s.*")


def top_correlated(df: DataFrame, target: str, cols: Sequence[str], k: int = 15) -> DataFrame:
    """The ``k`` features with largest |r| against ``target`` (signed r kept)."""
    row = df.agg(*[F.corr(num(c), num(target)).alias(f"r{i}") for i, c in enumerate(cols)])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r")) for i, c in enumerate(cols)]))
        .alias("s")).select("s.*")
    return long.where(F.col("r").isNotNull()).orderBy(F.abs("r").desc(), "feature").limit(k)


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max] (per group when ``by``); the
    last bin is closed; empty bins are emitted with count 0. Edges are
    ``min + i * ((max - min) / n)``, the last one max; a value belongs to the
    last edge at or below it, by comparison: the quotient only says where to look."""
    x = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    rng = x.groupBy(*by).agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    j = x.join(checked_broadcast(rng), list(by), "inner") if by else attach_row(x, rng)
    v, width = F.col(col).cast("double"), F.col("hi") - F.col("lo")

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * (width / F.lit(float(bins))))

    j = j.withColumn("__near", F.when(width == 0, 0).otherwise(
        F.greatest(F.least(F.floor((v - F.col("lo")) / width * bins), F.lit(bins - 1)), F.lit(0))).cast("int"))
    near = F.col("__near")
    b = near - (v < edge(near)).cast("int") + ((v >= edge(near + 1)) & (near < bins - 1)).cast("int")
    counts = j.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = rng.select(*by, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = spine.join(counts, [*by, "bin"], "left").fillna(0, subset=["count"])
    return out.select(*by, "bin",
                      edge(F.col("bin")).alias("edge_lo"), edge(F.col("bin") + 1).alias("edge_hi"),
                      F.col("count").cast("long").alias("count"))


def box_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (extreme data inside the fences) and
    outlier count per group. Quartiles are exact distributed quantiles; the
    per-group fences (one row per group) are joined back to the rows."""
    x = df.where(F.col(value).isNotNull())
    q = _quantile_cols(x, value, [0.25, 0.5, 0.75], [by], ["q1", "median", "q3"])
    n = x.groupBy(by).agg(F.count(value).alias("n"))
    q = n.join(q, by).withColumn("iqr", F.col("q3") - F.col("q1"))
    j = x.join(checked_broadcast(q.select(by, "q1", "q3", "iqr")), by)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col(value) >= lo_f) & (F.col(value) <= hi_f)
    w = j.groupBy(by).agg(
        F.min(F.when(inside, F.col(value))).cast("double").alias("whisker_lo"),
        F.max(F.when(inside, F.col(value))).cast("double").alias("whisker_hi"),
        F.sum((~inside).cast("long")).alias("n_outliers"))
    return q.join(w, by).select(by, "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "n_outliers")


def percentile_by(df: DataFrame, by: Sequence[str], value: str, p: float, name: str) -> DataFrame:
    """Exact interpolated percentile per group (distributed)."""
    return _quantile_cols(df, value, [p], list(by), [name])


def argmin_by_group(df: DataFrame, by: str | Sequence[str], label: str, score: str) -> DataFrame:
    """Per group the ``label`` with the smallest ``score``
    (ties -> smallest label); ``min_by`` is a partial aggregate."""
    keys = [by] if isinstance(by, str) else list(by)
    return df.where(F.col(score).isNotNull()).groupBy(*keys).agg(
        F.min_by(F.col(label), F.struct(F.col(score), F.col(label))).alias(label),
        F.min(score).alias(score))


def top_k_groups_by_sum(df: DataFrame, key: str, value: str, k: int, name: str = "total") -> DataFrame:
    """Groups with the largest sums (ties -> smaller key)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(name))
              .orderBy(F.col(name).desc(), F.col(key).asc()).limit(k))


def count_groups_at_least(df: DataFrame, key: str, k: int) -> DataFrame:
    """Group sizes and the number of groups with at least ``k`` rows."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    return g.agg(F.count(F.lit(1)).alias("n_groups"),
                 F.sum((F.col("size") >= k).cast("long")).alias("n_groups_ge_k"))


def mean_popstd(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean and population std (``np.std``) over folds."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


# ---------------------------------------------------------------- inference
def welch_from_moments(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column):
    """A19 pieces: Welch t and Welch-Satterthwaite df from count/mean/var_samp."""
    se1, se2 = v1 / n1, v2 / n2
    t = (m1 - m2) / F.sqrt(se1 + se2)
    dof = (se1 + se2) ** 2 / (se1 ** 2 / (n1 - 1) + se2 ** 2 / (n2 - 1))
    return t, dof


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(student_t_two_sided_p(t.to_numpy(dtype=float), dof.to_numpy(dtype=float)))


def welch_test(df: DataFrame, by: Sequence[str], arm: str, value: str, a, b) -> DataFrame:
    """Two-sided Welch t-test of ``value`` between arms ``a`` and ``b`` per
    group. Moments are one aggregate; the t CDF runs on the aggregated rows."""
    g = df.groupBy(*by).agg(
        F.count(F.when(F.col(arm) == a, F.col(value))).alias("n_a"),
        F.avg(F.when(F.col(arm) == a, F.col(value))).alias("mean_a"),
        F.var_samp(F.when(F.col(arm) == a, F.col(value))).alias("var_a"),
        F.count(F.when(F.col(arm) == b, F.col(value))).alias("n_b"),
        F.avg(F.when(F.col(arm) == b, F.col(value))).alias("mean_b"),
        F.var_samp(F.when(F.col(arm) == b, F.col(value))).alias("var_b"))
    t, dof = welch_from_moments(F.col("n_a"), F.col("mean_a"), F.col("var_a"),
                                F.col("n_b"), F.col("mean_b"), F.col("var_b"))
    g = g.withColumn("t_stat", t).withColumn("dof", dof)
    return g.withColumn("p_value", t_two_sided_p(F.col("t_stat"), F.col("dof")))


def chunk_rows(n_boot: int, most: int = CHUNK_ROWS) -> int:
    """Rows of a block of weights, which then stays in a core's cache."""
    return max(min(most, CHUNK_CELLS // max(n_boot, 1)), 1)


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` by its keys in at least a partition a core: a few MB of rows are
    rows x replicates of work, which merged small partitions would leave to one
    task."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(parts, *keys)


def weighted_partials(df: DataFrame, by: Sequence[str], row_key: str, cols: Sequence[str],
                      n_boot: int, seed: int, weights=poisson1_weights) -> DataFrame:
    """Per task: for every replicate r and group, sum(w) and sum(w * col) with
    Poisson(1) weights hashed from (row key, r, seed), so the result does not
    depend on partitioning. Output rows: tasks x groups x replicates. A task
    holds at most HELD_SUMS sums: with more groups it passes what it has on, and
    the shuffle by (group, replicate) adds up."""
    by, chunk = list(by), chunk_rows(n_boot)
    schema = T.StructType([*(df.schema[k] for k in by), T.StructField("rep", T.IntegerType()),
                           T.StructField("sw", T.DoubleType()),
                           *[T.StructField(f"s_{c}", T.DoubleType()) for c in cols]])

    def run(it):
        acc: dict = {}
        for pdf in it:
            if pdf.empty:
                continue
            groups = pdf.groupby(by, sort=False, dropna=False).indices if by else {(): np.arange(len(pdf))}
            for g, ix in groups.items():
                g = g if isinstance(g, tuple) else (g,)
                sums = acc.setdefault(g, np.zeros((1 + len(cols), n_boot)))
                keys = pdf[row_key].to_numpy(dtype=np.int64)[ix]
                values = np.vstack([np.ones(len(ix)), *[pdf[c].to_numpy(dtype=float)[ix] for c in cols]])
                for lo in range(0, len(ix), chunk):   # bounded rows x reps block
                    sums += values[:, lo:lo + chunk] @ weights(keys[lo:lo + chunk], n_boot, seed).astype(float)
                if len(acc) * (1 + len(cols)) * n_boot > HELD_SUMS:
                    yield from told(acc)
                    acc = {}
        yield from told(acc)

    def told(acc: dict):
        for g, sums in acc.items():
            out = {k: [v] * n_boot for k, v in zip(by, g)}
            out["rep"] = np.arange(n_boot, dtype=np.int32)
            out["sw"] = sums[0]
            for j, c in enumerate(cols):
                out[f"s_{c}"] = sums[j + 1]
            yield pd.DataFrame(out)

    parts = dealt(df.select(*by, row_key, *cols), [row_key, *cols]).mapInPandas(run, schema)
    return parts.groupBy(*by, "rep").agg(F.sum("sw").alias("sw"),
                                         *[F.sum(f"s_{c}").alias(f"s_{c}") for c in cols])


def bootstrap_mean_diff_ci(df: DataFrame, by: Sequence[str], arm: str, value: str, row_key: str,
                           a, b, n_boot: int = 2000, alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """Unpaired percentile bootstrap CI of mean(a) - mean(b) per group
    (Poisson bootstrap: each arm resampled independently)."""
    x = df.select(*by, row_key, F.when(F.col(arm) == a, F.col(value)).alias("va"),
                  F.when(F.col(arm) == b, F.col(value)).alias("vb"),
                  (F.col(arm) == a).cast("double").alias("ia"), (F.col(arm) == b).cast("double").alias("ib"))
    x = x.fillna(0.0, subset=["va", "vb"])
    # separate weights per arm: arm b uses a shifted seed
    pa = weighted_partials(x.where(F.col("ia") == 1), by, row_key, ["va"], n_boot, seed)
    pb = weighted_partials(x.where(F.col("ib") == 1), by, row_key, ["vb"], n_boot, seed + 7919)
    reps = pa.join(pb.withColumnRenamed("sw", "sw_b"), [*by, "rep"])
    diffs = reps.select(*by, "rep", (F.col("s_va") / F.col("sw") - F.col("s_vb") / F.col("sw_b")).alias("d"))
    return diffs.groupBy(*by).agg(F.percentile("d", [alpha / 2, 1 - alpha / 2]).alias("ci")).select(
        *by, F.col("ci")[0].alias("ci_lower"), F.col("ci")[1].alias("ci_upper"))


def bootstrap_paired(df: DataFrame, by: Sequence[str], a_col: str, b_col: str, row_key: str,
                     n_boot: int = 2000, alpha: float = 0.05, seed: int = 42,
                     with_p: bool = False) -> DataFrame:
    """Paired bootstrap of mean(a) - mean(b) (pairs share a weight):
    percentile CI, and with ``with_p`` the share of replicate differences on the
    other side of 0 from the observed one (not doubled)."""
    x = df.where(F.col(a_col).isNotNull() & F.col(b_col).isNotNull())
    part = weighted_partials(x, by, row_key, [a_col, b_col], n_boot, seed)
    d = part.select(*by, "rep", ((F.col(f"s_{a_col}") - F.col(f"s_{b_col}")) / F.col("sw")).alias("d"))
    obs = x.groupBy(*by).agg((F.avg(a_col) - F.avg(b_col)).alias("diff"), F.count(F.lit(1)).alias("n"))
    d = d.join(obs, list(by)) if by else attach_row(d, obs)
    other = F.when(F.col("diff") <= 0, (F.col("d") >= 0)).otherwise(F.col("d") <= 0).cast("double")
    res = d.groupBy(*by, "diff", "n").agg(
        F.percentile("d", [alpha / 2, 1 - alpha / 2]).alias("ci"), F.avg(other).alias("p_value"))
    cols = [*by, "n", "diff", F.col("ci")[0].alias("ci_lower"), F.col("ci")[1].alias("ci_upper")]
    if with_p:
        cols.append("p_value")
    return res.select(*cols)
