"""Event-centred range joins.

For each event centre ``c`` with half-width ``w``:

* pre  = rows with ``c - w <= t < c``
* post = rows with ``c <= t <= c + w`` except the first of them in (t, tie)
  order (the reference's ``mid + 1``), which at a centre with no row at ``c``
  drops the first later row.

Plan: ``bucket = t div ceil(w/2)``; each event probes buckets b-2..b+2 (5
rows per event) and is equi-joined to the series on the bucket, then filtered
by the exact range. The event side is broadcast behind a size check; otherwise a
shuffle join on the bucket, where AQE splits a dense (skewed) bucket. Work is
proportional to the rows inside the windows, never events x rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast, cut_lineage


ROW_T, ROW_TIE = "row_t", "row_tie"   # series tick / tie in the output


def _bucket(col: str, w: int) -> Column:
    return F.expr(f"({col} - pmod({col}, {int(w)}L)) div {int(w)}L")


def event_windows(series: DataFrame, events: DataFrame, *, t_col: str, tie_col: str, value_cols: Sequence[str],
                  event_keys: Sequence[str], centre_col: str, half_width: int,
                  role_col: str = "role") -> DataFrame:
    """Rows of ``series`` around each event centre, labelled pre / post.

    ``series`` has (t_col, tie_col, *value_cols); ``events`` has
    (*event_keys, centre_col) plus any attributes (kept). Centres and ticks are
    integers in the same unit; ``tie_col`` is unique per series row. The series
    tick / tie come out as ``row_t`` / ``row_tie``.

    The dropped centre row (first row at/after the centre by (t, tie)) is found
    per event by a forward as-of lookup on the series, so the joined window
    rows need no sort or extra shuffle.
    """
    from .asof import asof_join
    w = int(half_width)
    s = series.select(F.col(t_col).alias("__t"), F.col(tie_col).alias("__tie"), *value_cols)
    e = events.withColumn("__c", F.col(centre_col).cast("long"))
    centre = s.select(F.col("__t").alias("__ct"), F.col("__tie").alias("__ctie"))
    e = asof_join(e, centre, on="__c", right_on="__ct", direction="forward", tolerance=w,
                  right_tie="__ctie")
    # one row per event: written once, so the size check and the join below
    # do not each re-run the as-of lookup
    e = cut_lineage(e)
    # half-width buckets: a window [c-w, c+w] touches at most 5 of them, so the
    # candidate span before the exact filter is 2.5w instead of 3w
    bw = max((w + 1) // 2, 1)
    e = e.withColumn("__b", F.explode(F.array(*[
        F.expr(f"((__c - pmod(__c, {bw}L)) div {bw}L) + {d}") for d in (-2, -1, 0, 1, 2)])))
    s = s.withColumn("__b", _bucket("__t", bw))
    j = s.join(checked_broadcast(e), "__b").where(
        (F.col("__t") >= F.col("__c") - w) & (F.col("__t") <= F.col("__c") + w))
    after = F.col("__t") >= F.col("__c")
    j = j.where(~after | F.col("__ctie").isNull() | (F.col("__tie") != F.col("__ctie")))
    return (j.withColumn(role_col, F.when(after, F.lit("post")).otherwise(F.lit("pre")))
             .drop("__b", "__c", "__ctie")
             .withColumnsRenamed({"__t": ROW_T, "__tie": ROW_TIE}))


def control_centre(t: Column, half_width: int, t_min: int, t_max: int, shift: int = 5) -> Column:
    """``t - shift*w``; if before the first tick use ``t + shift*w``; if
    after the last tick there is no control (null)."""
    c = F.when(t - shift * half_width < F.lit(t_min), t + shift * half_width).otherwise(t - shift * half_width)
    return F.when(c > F.lit(t_max), F.lit(None).cast("long")).otherwise(c)


def window_moments(series: DataFrame, centres: DataFrame, *, t_col: str, tie_col: str, value_col: str,
                   centre_keys: Sequence[str], centre_col: str, half_width: int) -> DataFrame:
    """J6 counts and sums per centre without materialising the window rows.

    Exact running totals over (t, tie) (``order.cumulative_sums``, decimal
    sums) are read at the window edges with two as-of joins:

    Sums are exact in a fixed-point scale about the series' mean (``Scaled``).

    * one backward lookup for three probes per centre: ``c-w-1``, ``c-1``
      (``t < x`` is ``t <= x-1`` on integer ticks) and ``c+w``;
    * one forward lookup at ``c`` for the first row at/after the centre (the
      dropped centre row).

    pre = ``N(< c) - N(< c-w)``; post = ``N(<= c+w) - N(< c)`` minus the
    centre row when it lies inside the window (sums alike). Work is
    O(rows + centres) instead of O(centres x rows per window).
    """
    from .asof import asof_join
    from .order import cumulative_sums
    from .window import Scaled, finite
    w = int(half_width)
    v = finite(value_col)
    centre, low, high = (float(z or 0.0) for z in series.agg(F.avg(v), F.min(v), F.max(v)).first())
    scaled = Scaled(F.lit(centre), F.lit(max(high - centre, centre - low)), 12)
    keys = list(centre_keys)
    s = series.select(F.col(t_col).cast("long").alias("__rt"), F.col(tie_col).alias("__rtie"),
                      F.lit(1).cast("long").alias("__one"),
                      scaled.first(v).cast("decimal(38,12)").alias("__xv"), v.alias("__x"))
    cum = cut_lineage(cumulative_sums(s, ["__rt", "__rtie"], ["__one", "__xv"]))
    tab = cum.select("__rt", "__rtie", F.col("__one_cum").alias("n"), F.col("__xv_cum").alias("s"), "__x")
    c = centres.select(*keys, F.col(centre_col).cast("long").alias("__c")).where(F.col("__c").isNotNull())
    probes = c.select(*keys, "__c", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), (F.col("__c") + d).alias("p"))
        for k, d in (("lo", -w - 1), ("mid", -1), ("hi", w))])).alias("__pr")).select(
        *keys, "__c", "__pr.kind", F.col("__pr.p").alias("__p"))
    back = asof_join(probes, tab.select("__rt", "__rtie", "n", "s"), on="__p", right_on="__rt",
                     direction="backward", right_tie="__rtie", bucket_width=max(w, 1))
    edges = back.groupBy(*keys).agg(
        *[F.max(F.when(F.col("kind") == k, F.col(v))).alias(f"{k}_{v}") for k in ("lo", "mid", "hi")
          for v in ("n", "s")])
    first = asof_join(c, tab.select("__rt", "__rtie", "__x"), on="__c", right_on="__rt", direction="forward",
                      right_tie="__rtie", bucket_width=max(w, 1)).select(*keys, "__c", F.col("__x").alias("ctr_x"))
    z = F.lit(0)
    j = first.join(edges, keys, "left")
    n_lo, s_lo = F.coalesce("lo_n", z), F.coalesce("lo_s", z)
    n_mid, s_mid = F.coalesce("mid_n", z), F.coalesce("mid_s", z)
    n_hi, s_hi = F.coalesce("hi_n", z), F.coalesce("hi_s", z)
    post_all = n_hi - n_mid
    total = lambda n, s: n * F.lit(centre) + s.cast("double") * scaled.scale
    return j.select(
        *keys, F.col("__c").alias(centre_col),
        (n_mid - n_lo).alias("pre_n"), total(n_mid - n_lo, s_mid - s_lo).alias("pre_sum"),
        F.when(post_all > 0, post_all - 1).otherwise(z).alias("post_n"),
        F.when(post_all > 0, total(post_all, s_hi - s_mid) - F.col("ctr_x")).otherwise(F.lit(0.0))
        .alias("post_sum"))
