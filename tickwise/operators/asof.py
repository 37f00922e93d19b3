"""As-of joins.

For every left row find the right row of the same key whose ordering value is
nearest (or last before / first after), optionally within a tolerance.

Plan shape (no fan-out, no cartesian product, no single partition):

* The ordering axis is cut into equi-depth buckets (``buckets.py``); left and
  right rows are unioned with a side flag and one hash exchange on
  (key, bucket). Backward match = ``last(right, ignorenulls)`` over a running
  frame ordered by (t, right-first, tie); forward match is the same running
  frame over the descending order. Both are O(n) running frames.
* A per-(key, bucket) summary (last / first right row, tiny compared with the
  data) is carried across buckets with a window over buckets, and joined back
  on (key, bucket) to fill rows whose own bucket has no candidate.
* ``strategy="fixed"`` cuts the axis into equal widths instead; with a
  tolerance each right row is then copied into both neighbouring buckets.

A hot key only ever sits in one partition per bucket, so its work is spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import tick_col

_SIDE = "__asof_side"    # 0 = right, 1 = left
_T = "__asof_t"
_TIE = "__asof_tie"
_B = "__asof_bucket"
_R = "__asof_r"


def _axis(df: DataFrame, on: str) -> Column:
    dt = df.schema[on].dataType.simpleString()
    if dt in ("double", "float") or dt.startswith("decimal"):
        return F.col(on).cast("double")
    return tick_col(df, on)


def _bucket(name: str, width: float, integral: bool) -> Column:
    if integral and float(width).is_integer():
        w = int(width)
        # exact floor division for long ticks (double division loses ns digits)
        return F.expr(f"({name} - pmod({name}, {w}L)) div {w}L")
    return F.floor(F.col(name) / F.lit(float(width))).cast("long")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] | str | None = None,
    *,
    right_on: str | None = None,
    right_by: Sequence[str] | str | None = None,
    tolerance: float | None = None,
    direction: str = "nearest",
    allow_exact_matches: bool = True,
    right_tie: str | None = None,
    backward_takes: str = "last",
    bucket_width: float | None = None,
    right_prefix: str = "",
    distance_col: str | None = None,
    strategy: str = "depth",
    target_rows: int = 20_000,
) -> DataFrame:
    """Left as-of join of ``left`` to ``right`` on the ordering column ``on``.

    ``direction`` is ``backward`` (right <= left), ``forward`` (right >= left)
    or ``nearest`` (closer one; equal distance -> backward). ``tolerance`` is
    inclusive. Among right rows with the same ordering value backward takes
    the last by ``right_tie`` (``backward_takes="first"`` flips that) and
    forward the first. Unmatched left rows get nulls. Time columns are
    compared as integer ticks (microseconds for timestamps).

    All right columns except the key/ordering columns are appended, prefixed
    with ``right_prefix``.

    ``strategy``: ``depth`` uses equi-depth buckets of about ``target_rows``
    rows (``buckets.py``) with the cross-bucket carry, so density never
    concentrates rows in one task; ``fixed``, for axes known to be even, uses
    fixed-width buckets (width = tolerance or ``bucket_width``).
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"direction {direction!r}")
    by = [by] if isinstance(by, str) else list(by or [])
    right_by = [right_by] if isinstance(right_by, str) else list(right_by or by)
    right_on = right_on or on
    if strategy not in ("fixed", "depth"):
        raise ValueError(f"strategy {strategy!r}")
    if tolerance is None and bucket_width is None and strategy == "fixed":
        raise ValueError("a fixed-bucket unbounded as-of join needs bucket_width")
    width = float(bucket_width or tolerance or 1.0)
    if tolerance is not None and width < tolerance:
        raise ValueError("bucket_width must be >= tolerance")

    payload = [c for c in right.columns if c not in set(right_by) | {right_on}]
    out_names = {c: f"{right_prefix}{c}" for c in payload}
    clash = set(out_names.values()) & set(left.columns)
    if clash:
        raise ValueError(f"right columns collide with left: {sorted(clash)}; pass right_prefix")

    keys = [f"__asof_k{i}" for i in range(len(by))]
    tie_expr = F.col(right_tie) if right_tie else F.lit(0)
    r_struct = F.struct(F.col(_T).alias("__t"), F.col(_TIE).alias("__tie"),
                        *[F.col(c).alias(c) for c in payload])

    lt = left.select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)],
        _axis(left, on).alias(_T),
        F.struct(*[F.col(c) for c in left.columns]).alias("__asof_l"),
    )
    rt = right.select(
        *[F.col(b).alias(k) for b, k in zip(right_by, keys)],
        _axis(right, right_on).alias(_T),
        tie_expr.alias(_TIE),
        *payload,
    ).where(F.col(_T).isNotNull())
    for k in keys:  # null keys never match (pandas drops them too)
        rt = rt.where(F.col(k).isNotNull())

    integral = lt.schema[_T].dataType.simpleString() == "bigint"
    replicate = tolerance is not None
    if strategy == "depth":
        from .buckets import fit_depth_buckets
        axis = lt.select(F.col(_T)).unionByName(rt.select(F.col(_T)))
        db = fit_depth_buckets(axis, _T, target_rows)
        lt = db.assign(lt, _T, _B)
        rt = db.assign(rt, _T, _B)
        carry = True
    else:
        lt = lt.withColumn(_B, _bucket(_T, width, integral))
        if replicate:
            # each right row serves its own and both neighbouring buckets
            rt = rt.withColumn(_B, F.explode(F.array(*[
                _bucket(_T, width, integral) + F.lit(d) for d in (-1, 0, 1)])))
        else:
            rt = rt.withColumn(_B, _bucket(_T, width, integral))
        carry = not replicate

    u = (
        lt.select(*keys, _B, _T, F.lit(1).alias(_SIDE), F.lit(None).cast(rt.schema[_TIE].dataType).alias(_TIE),
                  F.col("__asof_l"), F.lit(None).cast(r_struct_type(rt, payload)).alias(_R))
        .unionByName(
            rt.select(*keys, _B, _T, F.lit(0).alias(_SIDE), F.col(_TIE),
                      F.lit(None).cast(lt.schema["__asof_l"].dataType).alias("__asof_l"),
                      r_struct.alias(_R)))
    )
    part = [*keys, _B]
    # exact matches: right rows with the same t are ordered before (allowed)
    # or after (disallowed) the left row in both scans
    side_first = F.col(_SIDE) if allow_exact_matches else -F.col(_SIDE)
    right_only = F.when(F.col(_SIDE) == 0, F.col(_R))
    bwd_tie = F.col(_TIE).asc_nulls_last() if backward_takes == "last" else F.col(_TIE).desc_nulls_last()
    w_bwd = (Window.partitionBy(*part).orderBy(F.col(_T).asc(), side_first.asc(), bwd_tie)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_fwd = (Window.partitionBy(*part).orderBy(F.col(_T).desc(), side_first.asc(),
                                               F.col(_TIE).desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if direction in ("backward", "nearest"):
        u = u.withColumn("__asof_bw", F.last(right_only, ignorenulls=True).over(w_bwd))
    if direction in ("forward", "nearest"):
        u = u.withColumn("__asof_fw", F.last(right_only, ignorenulls=True).over(w_fwd))
    u = u.where(F.col(_SIDE) == 1)

    if carry:
        u = _fill_from_neighbour_buckets(u, rt, keys, payload, direction, backward_takes, r_struct)

    bw = F.col("__asof_bw") if direction != "forward" else F.lit(None)
    fw = F.col("__asof_fw") if direction != "backward" else F.lit(None)
    bd = F.col(_T) - F.col("__asof_bw.__t") if direction != "forward" else F.lit(None)
    fd = F.col("__asof_fw.__t") - F.col(_T) if direction != "backward" else F.lit(None)
    if direction == "backward":
        pick, dist = bw, bd
    elif direction == "forward":
        pick, dist = fw, fd
    else:
        use_bw = bd.isNotNull() & (fd.isNull() | (bd <= fd))
        pick = F.when(use_bw, bw).otherwise(fw)
        dist = F.when(use_bw, bd).otherwise(fd)
    if tolerance is not None:
        pick = F.when(dist <= F.lit(tolerance), pick)
        dist = F.when(dist <= F.lit(tolerance), dist)
    u = u.select("__asof_l", pick.alias("__asof_m"), dist.alias("__asof_d"))
    cols = [F.col(f"__asof_l.{c}").alias(c) for c in left.columns]
    cols += [F.col(f"__asof_m.{c}").alias(out_names[c]) for c in payload]
    if distance_col:
        cols.append(F.col("__asof_d").alias(distance_col))
    return u.select(*cols)


def r_struct_type(rt: DataFrame, payload: list[str]):
    from pyspark.sql import types as T
    fields = [T.StructField("__t", rt.schema[_T].dataType), T.StructField("__tie", rt.schema[_TIE].dataType)]
    fields += [T.StructField(c, rt.schema[c].dataType) for c in payload]
    return T.StructType(fields)


def _fill_from_neighbour_buckets(u, rt, keys, payload, direction, backward_takes, r_struct):
    """Unbounded search: carry the nearest right row of earlier / later buckets.

    Summary rows are one per non-empty (key, bucket) of either side, so the
    window over buckets handles far fewer rows than the data.
    """
    part = [*keys, _B]
    first = F.min_by(r_struct, F.struct(F.col(_T), F.col(_TIE)))
    if backward_takes == "last":
        last = F.max_by(r_struct, F.struct(F.col(_T), F.col(_TIE)))
        summ = rt.groupBy(*part).agg(last.alias("__asof_last"), first.alias("__asof_first"))
    else:
        # the smallest tie at the last tick: ties of any type have no negative, so the ticks are found first
        per_tick = rt.groupBy(*part, _T).agg(first.alias("__r"))
        summ = per_tick.groupBy(*part).agg(F.max_by("__r", F.col(_T)).alias("__asof_last"),
                                           F.min_by("__r", F.col(_T)).alias("__asof_first"))
    lb = u.select(*part).distinct()
    summ = summ.join(lb, part, "full")
    # both carries are running frames (O(n)); "unbounded following" frames
    # would be recomputed per row
    up = Window.partitionBy(*keys).orderBy(F.col(_B).asc()).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.col(_B).desc()).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(
        *part,
        F.last("__asof_last", ignorenulls=True).over(up).alias("__asof_prev"),
        F.last("__asof_first", ignorenulls=True).over(down).alias("__asof_next"),
    )
    u = u.join(summ, part, "left")
    if direction in ("backward", "nearest"):
        u = u.withColumn("__asof_bw", F.coalesce("__asof_bw", "__asof_prev"))
    if direction in ("forward", "nearest"):
        u = u.withColumn("__asof_fw", F.coalesce("__asof_fw", "__asof_next"))
    return u
