"""Scalar column expressions.

All are built-in Catalyst expressions (codegen, no Python per row). Spark 4
runs with ANSI mode on, so lenient casts use ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for equal results.
NUMERIC_COLS = ["latency_us", "jitter_us", "queue_delay_us", "enforcement_latency_us",
                "control_action_delay_us", "cycle_time_us", "deadline_us"]
BOOLEAN_COLS = ["latency_violation", "jitter_violation", "success_flag", "anomaly_label"]
NULL_STRATUM = "<null>"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """pandas treats NaN as missing; Spark does not. Normalise at every source."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
          and (cols is None or f.name in cols)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in fl})


def to_ns_ticks(df: DataFrame, col: str = "timestamp_ns") -> DataFrame:
    """Epoch-ns integer, timestamp or parseable string -> long ns
    ticks (UTC). Missing column: no-op."""
    if col not in df.columns:
        return df
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        v = F.unix_micros(c.cast("timestamp")) * 1000
    elif isinstance(dt, T.StringType):
        as_num = F.expr(f"try_cast(`{col}` as bigint)")
        v = F.coalesce(as_num, F.unix_micros(F.to_timestamp(c)) * 1000)
    else:
        v = c.cast("long")
    return df.withColumn(col, v)


def ns_to_timestamp(c: str | Column) -> Column:
    """Ns ticks -> UTC timestamp, rounded down to the microsecond in integer
    arithmetic (a double holds no ns tick of this century exactly)."""
    ns = col_(c).cast("long")
    thousand = F.lit(1000).cast("long")
    return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, thousand), thousand))


def coerce_numeric(df: DataFrame, cols: Sequence[str] = NUMERIC_COLS) -> DataFrame:
    """Lenient numeric cast (unparseable -> null) on the listed columns present."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as double)") for c in cols if c in df.columns})


def lenient_bool(c: str) -> Column:
    """Numeric -> ``bool(int(x))`` (truncation: 0.5 -> False, 2 -> True); the
    words true and false in any case; anything else ("yes", "t") -> null."""
    num = F.expr(f"try_cast(try_cast(`{c}` as double) as bigint)")
    word = F.lower(F.trim(F.col(c).cast("string")))
    return F.coalesce(num != 0, F.when(word == "true", True).when(word == "false", False))


def coerce_boolean(df: DataFrame, cols: Sequence[str] = BOOLEAN_COLS) -> DataFrame:
    return df.withColumns({c: lenient_bool(c) for c in cols if c in df.columns})


def bool_to_double(df: DataFrame) -> DataFrame:
    """C4: every boolean column -> nullable 0/1 double."""
    return df.withColumns({f.name: F.col(f.name).cast("int").cast("double")
                           for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)})


def unit_scale(c: str | Column, factor: float = 1000.0) -> Column:
    """Unit scaling (us -> ms, ns -> us)."""
    return col_(c) / F.lit(factor)


def binary_target(c: str | Column, threshold: float = 120.0) -> Column:
    """``x > threshold`` as 0/1; missing -> 0."""
    return F.coalesce((col_(c) > F.lit(threshold)).cast("int"), F.lit(0))


def prob_flag(p: str | Column, inclusive: bool = True, cut: float = 0.5) -> Column:
    """``p >= cut`` (online scoring) or ``p > cut`` (sequence evaluation)."""
    return (col_(p) >= cut) if inclusive else (col_(p) > cut)


def round_half_even(c: str | Column, nd: int) -> Column:
    """Python/NumPy style rounding (``bround``); ``F.round`` is half-up."""
    return F.bround(col_(c), nd)


def strata_key(cols: Sequence[str], sep: str = "|") -> Column:
    """C11: pipe-joined string key; nulls become their own stratum."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_STRATUM)) for c in cols])


def residuals(y: str | Column, p: str | Column) -> dict[str, Column]:
    """Residual, absolute error and APE (%) with the 1e-8 guard."""
    r = col_(y) - col_(p)
    return {"residual": r, "abs_error": F.abs(r),
            "ape": F.abs(r / (col_(y) + F.lit(1e-8))) * 100}


def treatment_indicator(c: str | Column) -> Column:
    """``notna -> 1 else 0``."""
    return col_(c).isNotNull().cast("int")


def lookup_default(c: str | Column, mapping: dict, default) -> Column:
    """Small fixed mapping with default (a ``CASE``; use ``joins.lookup``
    for data-sized maps)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[col_(c)], F.lit(default))


def cols_by_type(df: DataFrame, kinds: Sequence[type]) -> list[str]:
    """Column names whose type is one of ``kinds`` (plan-time)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, tuple(kinds))]


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def numeric_columns(df: DataFrame, drop_ids: bool = True,
                    extra_drop: Sequence[str] = ("timestamp_ns", "event_id", "action_id")) -> list[str]:
    """P4 + P5 + C12: numeric columns, minus ``*_id`` and the listed ones."""
    cols = cols_by_type(df, NUMERIC_TYPES)
    if drop_ids:
        cols = [c for c in cols if not c.endswith("_id") and c not in set(extra_drop)]
    return cols


def derived_features(df: DataFrame, *, ratio: tuple[str, str] | None = None,
                     product: tuple[str, str] | None = None, severity_col: str | None = None,
                     state_col: str | None = None, key: str | None = None,
                     high_levels: Sequence[str] = ("High", "Critical"),
                     attack_state: str = "Under Attack") -> DataFrame:
    """C18 (documented in the reference's EDA notes, not implemented there):
    ratio and product of two measures, high-severity and under-attack flags,
    and rows per key (a grouped count joined back: no window over a hot key)."""
    out = df
    if ratio:
        a, b = ratio
        out = out.withColumn(f"{a}_per_{b}", F.when(F.col(b) != 0, F.col(a) / F.col(b)))
    if product:
        a, b = product
        out = out.withColumn(f"{a}_x_{b}", F.col(a) * F.col(b))
    if severity_col:
        out = out.withColumn("is_high_severity", F.col(severity_col).isin(*high_levels).cast("int"))
    if state_col:
        out = out.withColumn("is_under_attack", (F.col(state_col) == attack_state).cast("int"))
    if key:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(f"rows_per_{key}"))
        out = out.join(counts, key, "left")
    return out
