"""Query registry: name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None).

Names start with the SURVEY §2 operator id they exercise. The oracle SQL runs
in DuckDB over the same Parquet tables; every computed column is aliased to
the same name on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ROUND = 8


def r8(col):
    """Round a computed double to 8 dp (the oracle SQL rounds the same)."""
    from pyspark.sql import functions as F
    return F.round(col if not isinstance(col, str) else F.col(col), ROUND)


def round_doubles(df, nd: int = ROUND):
    """Round every double column of a result to ``nd`` dp."""
    from pyspark.sql import functions as F
    return df.select(*[F.round(f.name, nd).alias(f.name) if f.dataType.simpleString() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def histogram_sql(rows: str, col: str, bins: int, by: str = "") -> str:
    """SELECT of an equal-width histogram of ``col`` over the CTE ``rows``, which
    counts the edges at or below each value."""
    key, group, using = (f"{by}, ", f" GROUP BY {by}", f" JOIN r USING ({by})") if by else ("", "", ", r")
    both = f"USING ({key}bin)"
    return f"""r AS (SELECT {key}min({col}) AS lo, max({col}) AS hi FROM {rows}{group}),
b AS (SELECT {key}CASE WHEN hi = lo THEN 0 ELSE CAST((SELECT count(*) FROM range(1, {bins}) e(i) WHERE {col} >= lo + e.i * ((hi - lo) / {bins}.0::DOUBLE)) AS INTEGER) END AS bin
      FROM {rows}{using} WHERE {col} IS NOT NULL),
c AS (SELECT {key}bin, count(*) AS count FROM b GROUP BY ALL),
s AS (SELECT {key}lo, hi, CAST(range AS INTEGER) AS bin FROM r, range({bins}))
SELECT {key}bin, round(lo + bin * ((hi - lo) / {bins}.0::DOUBLE), 8) AS edge_lo,
       round(CASE WHEN bin = {bins - 1} THEN hi ELSE lo + (bin + 1) * ((hi - lo) / {bins}.0::DOUBLE) END, 8) AS edge_hi, coalesce(c.count, 0) AS count
FROM s LEFT JOIN c {both}"""


Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    from . import q_joins  # noqa: F401  (modules register on import)
    for mod in ("q_order", "q_windows", "q_stats", "q_sampling", "q_encode", "q_eval",
                "q_causal", "q_models", "q_streaming", "q_sources", "q_features"):
        try:
            __import__(f"{__package__}.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"{__package__}.{mod}":
                raise
    return REGISTRY
