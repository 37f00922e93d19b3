"""Row-position semantics on an unordered engine.

``with_row_index`` gives every row its 0-based position in a total order
(order columns must make rows unique; add a tie-break column). Plan:

1. ``repartitionByRange(P, order)`` + ``sortWithinPartitions(order)``:
   sampled range bounds, P parallel sorts, no single-partition exchange.
2. ``spark_partition_id`` / ``monotonically_increasing_id`` are stamped and
   the result is written with a reliable checkpoint, so both passes below see
   exactly the same partitioning and ids even if executors are lost.
3. A P-row table (count, first id per partition) gets running offsets; it is
   broadcast (its size is the partition count) and ``row_idx = id - first +
   offset``.

Positional operators (splits, slices, zip joins, systematic samples) are range
predicates on ``row_idx`` with bounds computed on the driver from ``n`` using
the reference's exact integer / rounding rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checked_broadcast, cut_lineage, scan_only

ROW_IDX = "row_idx"


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = ROW_IDX,
                   num_partitions: int | None = None,
                   partition_by: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """Add a dense 0-based ``name`` column following ``order`` (restarting
    per ``partition_by`` key when given); returns ``(frame, n_rows)``. The
    frame is checkpointed (lineage cut).

    Keyed form: the range partitioning is on (key, order), so a hot key is
    split over several partitions; per (partition, key) first ids and running
    offsets come from a summary with one row per (partition, key).
    """
    spark = df.sparkSession
    pb = list(partition_by)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # more than a scan is written before the bounds are sampled, so that it runs once
    df = df if scan_only(df) else cut_lineage(df)
    oc = [F.col(c) for c in pb] + _cols(order)
    ranged = (df.repartitionByRange(parts, *oc).sortWithinPartitions(*oc)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("__pid", *pb).agg(F.count(F.lit(1)).alias("__n"),
                                              F.min("__mid").alias("__m0"))
    w = Window.partitionBy(*pb).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", *pb, "__m0", "__n",
                            F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    if pb:
        offsets = cut_lineage(offsets)
    n = offsets.agg(F.sum("__n")).first()[0] or 0
    offsets = offsets.drop("__n")
    if pb:
        # one row per (partition, key): broadcast only under the row bound
        o = checked_broadcast(offsets.withColumnsRenamed({c: f"__o_{c}" for c in ["__pid", *pb]}))
        cond = F.col("__pid") == F.col("__o___pid")
        for c in pb:
            cond = cond & F.col(c).eqNullSafe(F.col(f"__o_{c}"))
        joined = ranged.join(o, cond).drop(*[f"__o_{c}" for c in ["__pid", *pb]])
    else:
        joined = ranged.join(F.broadcast(offsets), "__pid")  # P rows
    out = (joined.withColumn(name, F.col("__mid") - F.col("__m0") + F.col("__off"))
                 .drop("__pid", "__mid", "__m0", "__off"))
    return out, int(n)


def split_bounds(n: int, train_frac: float = 0.70, val_frac: float = 0.15) -> tuple[int, int]:
    """W9 bounds: ``int(n*train)``, ``int(n*(train+val))`` (truncation)."""
    return int(n * train_frac), int(n * (train_frac + val_frac))


def chrono_split(df: DataFrame, order: Sequence[str | Column], train_frac: float = 0.70,
                 val_frac: float = 0.15, col: str = "split") -> DataFrame:
    """Chronological train/val/test split by row position."""
    idx, n = with_row_index(df, order)
    a, b = split_bounds(n, train_frac, val_frac)
    r = F.col(ROW_IDX)
    return idx.withColumn(col, F.when(r < a, "train").when(r < b, "val").otherwise("test"))


def fold_bounds(n: int, n_splits: int) -> list[int]:
    """W10 boundaries ``int(round(i*n/(k+1)))`` (Python round = half-even)."""
    return [int(round(i * n / (n_splits + 1))) for i in range(n_splits + 2)]


def expanding_folds(df: DataFrame, order: Sequence[str | Column], n_splits: int = 5) -> DataFrame:
    """Long-form fold membership ``(fold, role)`` for expanding-window CV.

    A row appears once per fold it belongs to (train for every later fold,
    val for one); folds with an empty side are skipped like the reference."""
    idx, n = with_row_index(df, order)
    b = fold_bounds(n, n_splits)
    r = F.col(ROW_IDX)
    members = []
    for i in range(n_splits):
        tr_end, va_end = b[i + 1], b[i + 2]
        if tr_end == 0 or va_end - tr_end == 0:
            continue
        fold = i + 1
        members.append(F.when(r < tr_end, F.struct(F.lit(fold).alias("fold"), F.lit("train").alias("role"))))
        members.append(F.when((r >= tr_end) & (r < va_end),
                              F.struct(F.lit(fold).alias("fold"), F.lit("val").alias("role"))))
    if not members:
        return idx.withColumn("fold", F.lit(None).cast("int")).withColumn("role", F.lit(None).cast("string")).limit(0)
    return (idx.withColumn("__m", F.explode(F.filter(F.array(*members), lambda x: x.isNotNull())))
               .select("*", "__m.fold", "__m.role").drop("__m"))


def positional_slice(df: DataFrame, order: Sequence[str | Column], start: int | None = None,
                     stop: int | None = None, *, frac: tuple[float, float] | None = None) -> DataFrame:
    """P10: ``iloc[start:stop]`` in ``order`` (negative indices count from the end);
    ``frac=(a, b)`` takes ``iloc[int(n*a):int(n*b)]``."""
    idx, n = with_row_index(df, order)
    if frac is not None:
        start, stop = int(n * frac[0]), int(n * frac[1])
    s, e, _ = slice(start, stop).indices(n)
    return idx.where((F.col(ROW_IDX) >= s) & (F.col(ROW_IDX) < e))


def zip_join(spine: DataFrame, spine_order: Sequence[str | Column], other: DataFrame,
             other_order: Sequence[str | Column], suffix: str = "_stab") -> DataFrame:
    """Positional concat. ``other`` is trimmed to the spine's length or
    padded with nulls; colliding ``other`` columns get ``suffix`` (P3)."""
    a, _ = with_row_index(spine, spine_order)
    b, _ = with_row_index(other, other_order, name="__zip_idx")
    ren = {c: f"{c}{suffix}" for c in other.columns if c in spine.columns or c == ROW_IDX}
    b = b.withColumnsRenamed(ren)
    return a.join(b, F.col(ROW_IDX) == F.col("__zip_idx"), "left").drop("__zip_idx")


def linspace_positions(n: int, k: int) -> list[int]:
    """T9 positions ``floor(i*(n-1)/(k-1))``, i < k, in exact integer maths
    (the float form can land one below an exact integer)."""
    if n <= 0:
        return []
    if k == 1:
        return [0]
    return [int(i * (n - 1) // (k - 1)) for i in range(k)]


def systematic_sample(df: DataFrame, order: Sequence[str | Column], k: int = 500) -> DataFrame:
    """Rows at ``k`` evenly spaced positions (duplicates collapse when k > n).
    The k positions are a parameter-sized list, so the semi-join broadcasts it."""
    idx, n = with_row_index(df, order)
    pos = sorted(set(linspace_positions(n, k)))
    posdf = df.sparkSession.createDataFrame([(int(p),) for p in pos] or [(-1,)], f"{ROW_IDX} long")
    return idx.join(F.broadcast(posdf), ROW_IDX, "left_semi")


def cumulative_sums(df: DataFrame, order: Sequence[str | Column], cols: Sequence[str],
                    partition_by: Sequence[str] = (), suffix: str = "_cum",
                    num_partitions: int | None = None) -> DataFrame:
    """Running totals of ``cols`` in ``order`` (inclusive), per ``partition_by``
    key when given, without a single-partition window: range partitioning,
    per-partition running sums, and offsets from a (partition, key) summary."""
    spark = df.sparkSession
    pb = list(partition_by)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # more than a scan is written before the bounds are sampled, so that it runs once
    df = df if scan_only(df) else cut_lineage(df)
    oc = [F.col(c) for c in pb] + _cols(order)
    ranged = (df.repartitionByRange(parts, *oc).sortWithinPartitions(*oc)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    w_in = (Window.partitionBy("__pid", *pb).orderBy("__mid")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumns({f"__loc_{c}": F.sum(c).over(w_in) for c in cols})
    tot = ranged.groupBy("__pid", *pb).agg(*[F.sum(c).alias(f"__tot_{c}") for c in cols])
    w_off = Window.partitionBy(*pb).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("__pid", *pb, *[F.coalesce(F.sum(f"__tot_{c}").over(w_off), F.lit(0)).alias(f"__off_{c}")
                                      for c in cols])
    offs = checked_broadcast(offs.withColumnsRenamed({c: f"__o_{c}" for c in ["__pid", *pb]}))
    cond = F.col("__pid") == F.col("__o___pid")
    for c in pb:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__o_{c}"))
    out = local.join(offs, cond).drop(*[f"__o_{c}" for c in ["__pid", *pb]])
    out = out.withColumns({f"{c}{suffix}": F.col(f"__loc_{c}") + F.col(f"__off_{c}") for c in cols})
    return out.drop("__pid", "__mid", *[f"__loc_{c}" for c in cols], *[f"__off_{c}" for c in cols])
