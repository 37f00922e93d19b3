"""Ordered-window operators without a single-partition exchange
(SURVEY W1-W5, W7, W8, W11-W13, F9).

Time-range windows (W1-W3) use *halo buckets*: ``own = t div B`` with
``B >= widest window``; each row is placed in its own bucket and, if a window of
the next one reaches back to it, there too; only rows in their own bucket are
kept. Every frame ``(t-w, t]`` lies in buckets ``own-1`` and ``own``, so the
result equals the global window. Rows with the same tick are peers and see each
other (SQL RANGE frames), unless ``exact_ties`` asks for the order of a tie
column. A bucket's windows are merged from moments of runs of rows
(``functions.moments``): O(log rows) a window, and no figure depends on values
outside its window. Buckets denser than a task should hold go through
differences of exact running totals over equi-depth buckets instead.

Row-count windows (lags W4, sequences W11/W12) use *index buckets*: a dense
row index (global or per key, ``order.with_row_index``), ``own = idx div B``,
and only the last ``k`` rows of each bucket are copied forward. A hot key is
spread over ``n_key / B`` buckets.

Forward-looking operations (backfill W5) use reversed running frames plus a
per-bucket carry, never "unbounded following" frames (which Spark re-evaluates
per row).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.moments import GrowingSeries, mean_std
from ..session import bounded_values, cut_lineage, tick_col
from .order import ROW_IDX, with_row_index

_T, _OWN, _B = "__w_t", "__w_own", "__w_bucket"
DEFAULT_INDEX_BUCKET = 1 << 18
MIN_INDEX_BUCKET = 1 << 13
#: Rows of a halo bucket (two of the widest windows) that a task answers at once.
SPAN_ROWS = 2_000_000
#: Rows of a bucket that are answered together.
ANSWERED_ROWS = 1 << 16


class Scaled:
    """Exact running sums of a double column at any magnitude.

    Values are shifted by a centre and divided by the largest distance from it,
    so they lie in [-1, 1]; as fixed-point numbers with ``digits`` decimals
    their sums and sums of squares are exact, and differences of running
    totals lose nothing. The variance is taken about the window's own mean, in
    fixed point too, before anything becomes a double: its error stays below
    1e-20 of the squared scale, whatever the prefix. Sums hold 10^(38 - 2 x
    digits) rows.
    """

    def __init__(self, centre: Column, scale: Column, digits: int):
        self.centre, self.digits = centre, digits
        self.scale = F.when(scale > 0, scale).otherwise(F.lit(1.0))

    def first(self, v: Column) -> Column:
        return ((v - self.centre) / self.scale).cast(f"decimal({self.digits + 2},{self.digits})")

    def second(self, v: Column) -> Column:
        x = self.first(v)
        return (x * x).cast(f"decimal(38,{2 * self.digits})")

    def mean(self, n: Column, s: Column) -> Column:
        return F.when(n > 0, self.centre + self.scale * (s.cast("double") / n))

    def std(self, n: Column, s: Column, q: Column) -> Column:
        """Sample standard deviation; null below two values."""
        d = self.digits
        mean = F.when(n > 0, (s / n.cast("decimal(12,0)")).cast(f"decimal({d + 2},{d})"))
        about = q - F.lit(2) * (mean * s.cast(f"decimal({38 - d - 3},{d})")) + mean * mean * n.cast("decimal(12,0)")
        var = F.greatest(about.cast("double"), F.lit(0.0)) / (n - 1)
        return F.when(n > 1, F.sqrt(var) * self.scale)


def finite(c: str | Column) -> Column:
    """The column as double; NaN and infinities are missing."""
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def _floor_div(col: str, width: int) -> Column:
    return F.expr(f"({col} - pmod({col}, {int(width)}L)) div {int(width)}L")


def rolling_time_stats(
    df: DataFrame,
    t_col: str,
    value_col: str,
    windows: Mapping[str, int],
    *,
    count_col: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_width: int | None = None,
    mean_name: str = "{v}_roll_mean_{w}",
    std_name: str = "{v}_roll_std_{w}",
    count_name: str = "rate_{w}",
    strategy: str = "moments",
    target_rows: int = 20_000,
    include_current: bool = True,
    exact_ties: bool = False,
    tie_col: str | None = None,
    span_rows: int | None = None,
) -> DataFrame:
    """Rolling mean, sample std (single row -> 0) and non-null count of
    ``count_col`` (default ``value_col``) over ``(t - width, t]`` per window.

    ``windows`` maps a label to a width in ticks of ``t_col`` (microseconds for
    timestamps, raw values for integer ticks). Rows are ordered globally
    (``partition_by`` restricts windows to a key, as an option).
    ``include_current=False`` leaves a row itself out of its windows (a target
    that must not see itself). ``exact_ties=True`` lets a row see only those
    rows of its tick that come before it in ``tie_col``, as pandas does.

    ``strategy="moments"`` answers a halo bucket in one task, from one exchange
    of the rows; buckets of more than ``span_rows`` rows (found by one count) are
    left to ``depth``: running totals over equi-depth buckets with carried
    offsets, and the total at ``t - width`` from a backward as-of join
    (``_rolling_depth``), at any density. ``fixed``, for axes known to be even,
    takes totals in halo buckets (neither option).
    """
    widths = {k: int(v) for k, v in windows.items()}
    bw = int(bucket_width or max(widths.values()))
    if bw < max(widths.values()):
        raise ValueError("bucket_width must be >= the widest window")
    if exact_ties and tie_col is None:
        raise ValueError("exact_ties needs a tie_col")
    if strategy == "fixed" and (exact_ties or not include_current):
        raise ValueError("the fixed strategy has neither include_current=False nor exact_ties")
    cc = count_col or value_col
    x = df.withColumn(_T, tick_col(df, t_col))
    x = x.withColumn(_OWN, _floor_div(_T, bw))
    depth = lambda rows: _rolling_depth(rows.drop(_OWN), value_col, widths, cc, list(partition_by), target_rows,
                                        mean_name, std_name, count_name, include_current, exact_ties, tie_col)
    if strategy == "moments" and any(isinstance(f.dataType, T.UserDefinedType) for f in df.schema.fields):
        strategy = "depth"  # vectors don't travel in Arrow batches
    if strategy == "depth":
        got = depth(x).drop(_T)
        return got.select(*df.columns, *[c for c in got.columns if c not in df.columns])
    if strategy == "moments":
        return _rolling_moments(x, df, value_col, widths, cc, list(partition_by), bw, (mean_name, std_name, count_name), include_current,
                                exact_ties, tie_col, int(span_rows or SPAN_ROWS), depth)
    x = x.withColumn(_B, F.explode(F.array(F.col(_OWN), F.col(_OWN) + 1)))
    v, whole = F.col("__w_v"), Window.partitionBy(*partition_by, _B)
    x = x.withColumn("__w_v", finite(value_col)).withColumn("__w_c", F.coalesce(F.avg("__w_v").over(whole), F.lit(0.0)))
    x = x.withColumn("__w_s", F.max(F.abs(v - F.col("__w_c"))).over(whole))
    scaled = Scaled(F.col("__w_c"), F.col("__w_s"), 14)
    x = x.withColumn("__w_x", scaled.first(v)).withColumn("__w_x2", scaled.second(v))
    base = Window.partitionBy(*partition_by, _B).orderBy(_T)
    upto = base.rangeBetween(Window.unboundedPreceding, 0)

    def totals(frame):
        return (F.count("__w_v").over(frame), F.sum("__w_x").over(frame), F.sum("__w_x2").over(frame),
                F.count(cc).over(frame))
    c1, s1, q1, k1 = totals(upto)
    cols = {}
    for label, width in widths.items():
        c0, s0, q0, k0 = totals(base.rangeBetween(Window.unboundedPreceding, -width))
        n = c1 - F.coalesce(c0, F.lit(0))
        sx, sq = s1 - F.coalesce(s0, F.lit(0)), q1 - F.coalesce(q0, F.lit(0))
        cols[mean_name.format(v=value_col, w=label)] = scaled.mean(n, sx)
        cols[std_name.format(v=value_col, w=label)] = F.coalesce(scaled.std(n, sx, sq), F.lit(0.0))
        cols[count_name.format(v=value_col, w=label)] = (k1 - F.coalesce(k0, F.lit(0))).cast("double")
    x = x.withColumns(cols)
    return x.where(F.col(_B) == F.col(_OWN)).drop(_T, _OWN, _B, "__w_x", "__w_x2", "__w_v", "__w_c", "__w_s")


def _rolling_moments(x: DataFrame, df: DataFrame, value_col: str, widths: Mapping[str, int], cc: str, pb: list[str], bw: int,
                     names: tuple[str, str, str], include_current: bool, exact_ties: bool, tie_col: str | None, span_rows: int, depth) -> DataFrame:
    """Halo buckets as groups: rows travel whole to their own bucket, copies for
    the next one without their other columns. Spark sorts a bucket; the task
    goes through it batch by batch and holds whole rows only until they are
    answered, of the others what ``GrowingSeries`` holds."""
    wide = max(widths.values())
    x = x.withColumn("__w_v", finite(value_col)).withColumn("__w_k", F.col(cc).isNotNull())
    own = F.struct(F.col(_OWN).alias(_B), F.lit(True).alias("__w_mine"))
    after = F.struct((F.col(_OWN) + 1).alias(_B), F.lit(False).alias("__w_mine"))
    visits = x.select("*", F.inline(F.when(F.col(_T) > (F.col(_OWN) + 1) * bw - wide, F.array(own, after)).otherwise(F.array(own))))
    span = [*pb, _B]
    dense = cut_lineage(visits.groupBy(*span).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > span_rows).drop("n"))
    crowded = dense.limit(1).count() > 0
    same = lambda left, right: reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in span])
    near = visits.join(dense, same(visits, dense), "left_anti") if crowded else visits
    tie, columns = [tie_col] if tie_col else [], list(df.columns)
    needed = {*pb, *tie}
    near = near.select(_T, "__w_v", "__w_k", "__w_mine", *[F.col(k).alias(f"__w_key{i}") for i, k in enumerate(pb)], _B,
                       *[F.col(c) if c in needed else F.when(F.col("__w_mine"), F.col(c)).alias(c) for c in df.columns])
    stats = [n.format(v=value_col, w=label) for label in widths for n in names]
    shape = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in df.schema.fields], *[T.StructField(c, T.DoubleType()) for c in stats]])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # halo rows come first; rows of the bucket wait, whole, until all of their tick have come
        series, waiting, told = GrowingSeries(), [], 0

        def ready(upto: int) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(waiting)
            waiting[:] = rows.slice(upto - told).to_batches()
            out = rows.slice(0, upto - told).combine_chunks()
            for label, width in widths.items():
                moments, n = series.rolling(told, upto, width, include_current, exact_ties)
                for name, values in zip(names, (*mean_std(moments), n.astype(np.float64))):
                    out = out.append_column(name.format(v=value_col, w=label), pa.array(values, from_pandas=True))
            yield from out.to_batches()

        for batch in batches:
            t = batch.column(_T)
            if t.null_count:  # without a tick, a bucket of its own: no windows
                empty = {n.format(v=value_col, w=label): x for label in widths for n, x in zip(names, (None, 0.0, 0.0))}
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), *(pa.array([x] * len(batch), pa.float64()) for x in empty.values())], [*columns, *empty])
                continue
            series.add(t.to_numpy(zero_copy_only=False), batch.column("__w_v").to_numpy(zero_copy_only=False).astype(float),
                       batch.column("__w_k").to_numpy(zero_copy_only=False))
            mine = batch.filter(batch.column("__w_mine")).select(columns)
            told += len(batch) - len(mine)
            if len(mine):
                waiting.append(mine)
            if len(series) - told >= ANSWERED_ROWS:
                upto = len(series) if exact_ties else int(np.searchsorted(series.t.seen(), series.t.seen()[-1]))
                if upto > told:
                    yield from ready(upto)
                    told = upto
        if len(series) > told:
            yield from ready(len(series))

    keys = [*[f"__w_key{i}" for i in range(len(pb))], _B]
    near = near.repartition(*keys).sortWithinPartitions(*keys, _T, *tie)
    out = near.groupBy(*keys).applyInArrow(answer, shape)
    if not crowded:
        return out
    # the rows of dense buckets and of those before them, whole; results of the former are kept
    reach = dense.unionAll(dense.withColumn(_B, F.col(_B) - 1)).distinct()
    rows = x.drop("__w_v", "__w_k").withColumn(_B, F.col(_OWN))
    far = rows.join(reach, same(rows, reach), "left_semi")
    far = depth(far.withColumnRenamed(_B, "__w_span"))
    kept = far.withColumnRenamed("__w_span", _B)
    return out.unionByName(kept.join(dense, same(kept, dense), "left_semi").select(*out.columns))


def _rolling_depth(x: DataFrame, value_col: str, widths: Mapping[str, int], cc: str, pb: list[str],
                   target_rows: int, mean_name: str, std_name: str, count_name: str, include_current: bool = True,
                   exact_ties: bool = False, tie_col: str | None = None) -> DataFrame:
    """Density-robust rolling statistics. A row's own value, or the later rows of
    its tick, are taken off the exact totals where the options ask for it.

    1. Equi-depth buckets on the tick; per (key, bucket) running totals
       (RANGE frame, peers included) plus the carried totals of earlier
       buckets of the key -> cumulative count / sum / sum of squares at every
       row (exact decimals).
    2. For each window, the cumulative totals at ``t - width`` come from a
       backward as-of join of (key, t - width) against the cumulative table; the
       window value is the difference.
    """
    from .asof import asof_join
    from .buckets import fit_depth_buckets
    # totals run over all buckets here, so one centre and scale serves all: one aggregate to three numbers
    v = finite(value_col)
    centre, low, high = (float(z or 0.0) for z in x.agg(F.avg(v), F.min(v), F.max(v)).first())
    scaled = Scaled(F.lit(centre), F.lit(max(high - centre, centre - low)), 12)
    x = x.withColumn("__w_x", scaled.first(v)).withColumn("__w_x2", scaled.second(v)).withColumn(
        "__w_c", v.isNotNull().cast("long")).withColumn("__w_k", F.col(cc).isNotNull().cast("long"))
    db = fit_depth_buckets(x.select(_T), _T, target_rows)
    x = db.assign(x, _T, _B)
    tots = ["__w_c", "__w_x", "__w_x2", "__w_k"]
    run = Window.partitionBy(*pb, _B).orderBy(_T).rangeBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"{c}_run": F.coalesce(F.sum(c).over(run), F.lit(0)) for c in tots})
    summ = x.groupBy(*pb, _B).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_tot") for c in tots])
    earlier = Window.partitionBy(*pb).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*pb, _B, *[F.coalesce(F.sum(f"{c}_tot").over(earlier), F.lit(0)).alias(f"{c}_off")
                                  for c in tots])
    x = x.join(summ, [*pb, _B], "left")
    x = x.withColumns({f"{c}_cum": F.col(f"{c}_run") + F.col(f"{c}_off") for c in tots})
    upto = {c: F.col(f"{c}_cum") for c in tots}
    if exact_ties:
        by_row = Window.partitionBy(*pb, _B).orderBy(_T, tie_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = {c: F.coalesce(F.sum(c).over(by_row), F.lit(0)) + F.col(f"{c}_off") for c in tots}
    if not include_current:
        upto = {c: e - F.coalesce(F.col(c), F.lit(0)) for c, e in upto.items()}
    x = x.withColumns({f"{c}_upto": e for c, e in upto.items()}).drop(*[f"{c}_run" for c in tots], *[f"{c}_off" for c in tots], _B)
    # the probes of all windows go through one as-of join, as narrow rows; written once, since both sides read it
    x = cut_lineage(x.withColumn("__w_id", F.monotonically_increasing_id()))
    cum = x.select(*pb, F.col(_T).alias("__w_tc"), *[F.col(f"{c}_cum").alias(f"{c}_at") for c in tots])
    edges = F.array(*[F.col(_T) - F.lit(int(w)) for w in widths.values()])
    probes = x.select("__w_id", *pb, F.posexplode(edges).alias("__w_k", "__w_probe"))
    got = asof_join(probes, cum, on="__w_probe", right_on="__w_tc", by=pb or None, direction="backward", target_rows=target_rows)
    at = got.groupBy("__w_id").agg(*[F.max(F.when(F.col("__w_k") == k, F.col(f"{c}_at"))).alias(f"{c}_at{k}")
                                     for k in range(len(widths)) for c in tots])
    out = x.join(at, "__w_id")
    for k, label in enumerate(widths):
        d = {c: F.col(f"{c}_upto") - F.coalesce(F.col(f"{c}_at{k}"), F.lit(0)) for c in tots}
        n = d["__w_c"]
        sx, sq = d["__w_x"], d["__w_x2"]
        out = out.withColumns({
            mean_name.format(v=value_col, w=label): scaled.mean(n, sx),
            std_name.format(v=value_col, w=label): F.coalesce(scaled.std(n, sx, sq), F.lit(0.0)),
            count_name.format(v=value_col, w=label): d["__w_k"].cast("double"),
        })
    return out.drop("__w_id", *tots, *[f"{c}_{end}" for c in tots for end in ("cum", "upto")],
                    *[f"{c}_at{k}" for k in range(len(widths)) for c in tots])


def _bucket_rows(df: DataFrame, n: int) -> int:
    """Rows of an index bucket: at least four buckets a shuffle partition, unless
    they would be small, so that all tasks have their share of the rows."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(DEFAULT_INDEX_BUCKET, max(MIN_INDEX_BUCKET, n // (4 * parts)))


def _index_buckets(idx: DataFrame, halo: int, bucket_rows: int, idx_col: str = ROW_IDX) -> DataFrame:
    """Own bucket plus a copy of the last ``halo`` rows into the next bucket."""
    b = int(max(bucket_rows, halo + 1))
    x = idx.withColumn(_OWN, _floor_div(idx_col, b))
    pos = F.pmod(F.col(idx_col), F.lit(b))
    return x.withColumn(_B, F.explode(F.when(pos >= b - halo, F.array(F.col(_OWN), F.col(_OWN) + 1))
                                      .otherwise(F.array(F.col(_OWN)))))


def lag_features(
    df: DataFrame,
    order: Sequence[str | Column],
    value_col: str,
    lags: Sequence[int],
    *,
    partition_by: Sequence[str] = (),
    backfill: bool = True,
    fill_value: float | None = 0.0,
    name: str = "{v}_lag_{k}",
    bucket_rows: int | None = None,
    indexed: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """W4 + W5: ``shift(k)`` in ``order`` (global unless ``partition_by``), then
    backfill (next non-null in order) and fill the rest with ``fill_value``.

    Output keeps ``row_idx`` (position in ``order``, per key when keyed).
    """
    lags = sorted(set(int(k) for k in lags))
    kmax = max(lags)
    idx, n = indexed or with_row_index(df, order, partition_by=partition_by)
    x = _index_buckets(idx, kmax, bucket_rows or _bucket_rows(df, n))
    w = Window.partitionBy(*partition_by, _B).orderBy(ROW_IDX)
    names = [name.format(v=value_col, k=k) for k in lags]
    x = x.withColumns({n: F.lag(value_col, k).over(w).cast("double") for n, k in zip(names, lags)})
    x = x.where(F.col(_B) == F.col(_OWN)).drop(_OWN)
    if backfill:
        # by the same column as the lags, so that the rows stay where they are
        x = backfill_columns(x, names, ROW_IDX, partition_by=partition_by, bucket_col=_B)
    if fill_value is not None:
        x = x.fillna(fill_value, subset=names)
    return x.drop(_B)


def backfill_columns(df: DataFrame, cols: Sequence[str], idx_col: str, *,
                     partition_by: Sequence[str] = (), bucket_col: str) -> DataFrame:
    """Replace nulls by the next non-null value in ``idx_col`` order.

    Inside a bucket: reversed running ``last(ignorenulls)``. Across buckets: a
    per-bucket summary (first non-null per column) carried from later buckets
    with a window over buckets, joined back on (key, bucket).
    """
    rev = (Window.partitionBy(*partition_by, bucket_col).orderBy(F.col(idx_col).desc())
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = df.withColumns({c: F.last(c, ignorenulls=True).over(rev) for c in cols})
    summ = x.groupBy(*partition_by, bucket_col).agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(idx_col))).alias(f"__bf_{c}")
          for c in cols])
    later = (Window.partitionBy(*partition_by).orderBy(F.col(bucket_col).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    summ = summ.select(*partition_by, bucket_col,
                       *[F.last(f"__bf_{c}", ignorenulls=True).over(later).alias(f"__bf_{c}") for c in cols])
    x = x.join(summ, [*partition_by, bucket_col], "left")
    return x.withColumns({c: F.coalesce(F.col(c), F.col(f"__bf_{c}")) for c in cols}).drop(
        *[f"__bf_{c}" for c in cols])


def sliding_sequences(
    df: DataFrame,
    order: Sequence[str | Column],
    features: Sequence[str],
    seq_len: int = 30,
    *,
    target_col: str | None = None,
    partition_by: Sequence[str] = (),
    seq_name: str = "seq",
    bucket_rows: int = DEFAULT_INDEX_BUCKET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Stride-1 windows of ``seq_len`` rows ending at each row whose
    (per-key) position is >= seq_len - 1; keys with fewer rows yield nothing.

    One feature gives ``array<double>``; several give ``array<array<double>>``
    (steps x features). The target is the last row's ``target_col``.
    """
    idx, _ = with_row_index(df, order, partition_by=partition_by)
    x = _index_buckets(idx, seq_len - 1, bucket_rows)
    step = (F.col(features[0]).cast("double") if len(features) == 1
            else F.array(*[F.col(f).cast("double") for f in features]))
    w = (Window.partitionBy(*partition_by, _B).orderBy(ROW_IDX)
         .rowsBetween(-(seq_len - 1), Window.currentRow))
    x = x.withColumn(seq_name, F.collect_list(step).over(w))
    x = x.where((F.col(_B) == F.col(_OWN)) & (F.col(ROW_IDX) >= seq_len - 1))
    cols = [*partition_by, ROW_IDX, *keep, seq_name]
    if target_col:
        cols.append(F.col(target_col).alias("target"))
    return x.select(*cols)


def context_rows(indexed: DataFrame, centres: DataFrame, n: int, before: int = 10,
                 width: int = 20, centre_col: str = ROW_IDX) -> DataFrame:
    """For each centre position ``i``: rows ``[lo, min(n, lo + width))``
    with ``lo = max(0, i - before)``. ``centres`` is a small (top-k) frame; its
    exploded ranges (k x width rows) are broadcast."""
    lo = F.greatest(F.lit(0), F.col(centre_col) - before)
    hi = F.least(F.lit(n), lo + width)
    rng = centres.select(F.col(centre_col).alias("centre_idx"),
                         F.explode(F.sequence(lo, hi - 1)).alias(ROW_IDX))
    return indexed.join(F.broadcast(rng), ROW_IDX, "inner")


def resample(df: DataFrame, t_col: str, width: int, aggs: Mapping[str, Column], *,
             fill_empty: bool = True, bin_col: str = "bin_start") -> DataFrame:
    """Fixed bins of ``width`` ticks; with ``fill_empty`` every bin from the
    first to the last is emitted (counts 0, means null), like ``resample``.
    The spine is ``spark.range`` over the bin ids, so it is distributed."""
    x = df.withColumn(_T, tick_col(df, t_col)).withColumn(_OWN, _floor_div(_T, width))
    g = x.groupBy(_OWN).agg(*[c.alias(n) for n, c in aggs.items()])
    if not fill_empty:
        return g.select((F.col(_OWN) * width).alias(bin_col), *aggs.keys())
    lo, hi = x.agg(F.min(_OWN), F.max(_OWN)).first()
    if lo is None:
        return g.select((F.col(_OWN) * width).alias(bin_col), *aggs.keys())
    spine = df.sparkSession.range(int(lo), int(hi) + 1).withColumnRenamed("id", _OWN)
    out = spine.join(g, _OWN, "left")
    counts = [n for n, c in aggs.items() if "count(" in str(c).lower()]
    out = out.fillna(0, subset=counts) if counts else out
    return out.select((F.col(_OWN) * width).alias(bin_col), *aggs.keys())


def grouped_bin_counts(df: DataFrame, key: str, t_col: str, width: int, *,
                       wide: bool = True, bin_col: str = "bin_start") -> DataFrame:
    """W8 + A12: per key, bins from the key's first to last bin with counts
    (empty bins 0); ``wide`` pivots keys to columns with 0 fill (keys must be
    a small categorical domain: they become the column list)."""
    x = df.withColumn(_T, tick_col(df, t_col)).withColumn(_OWN, _floor_div(_T, width))
    counts = x.groupBy(key, _OWN).agg(F.count(F.lit(1)).alias("n"))
    span = x.groupBy(key).agg(F.min(_OWN).alias("lo"), F.max(_OWN).alias("hi"))
    spine = span.select(key, F.explode(F.sequence("lo", "hi")).alias(_OWN))
    long = spine.join(counts, [key, _OWN], "left").fillna(0, subset=["n"])
    long = long.select(key, (F.col(_OWN) * width).alias(bin_col), F.col("n").cast("long").alias("n"))
    if not wide:
        return long
    keys = sorted(r[0] for r in bounded_values(long.where(F.col(key).isNotNull()).select(key).distinct(), 1000, f"pivot of {key}"))
    return long.groupBy(bin_col).pivot(key, keys).agg(F.sum("n")).fillna(0)
