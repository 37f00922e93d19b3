"""Session construction and small cluster-safety helpers.

Everything here is driver-side configuration; no data passes through it.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows above which a side is never broadcast, whatever the optimizer thinks.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tickwise") -> SparkSession:
    """Session tuned for this library: AQE on, UTC, Arrow, UI off.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[$BENCH_CPUS or 8]``.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or f"local[{cpus}]")
    parts = shuffle_partitions or cpus
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TICKWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``tickwise`` importable in Python workers (pandas UDFs and
    ``mapInPandas`` functions are pickled by module reference): zip the package
    once per SparkContext and ``addPyFile`` it, as ``--py-files`` would."""
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_tickwise_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="tickwise-pyfiles-"), "tickwise.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    sc._tickwise_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used. Only a local-mode session without the setting (tests,
    benches) gets a fresh private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickwise-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: data is written to the shared checkpoint folder,
    so a lost executor re-reads it instead of recomputing a plan whose
    partitioning or ids might differ on the second run.

    The plan is persisted while the checkpoint is written (an eager reliable
    checkpoint otherwise computes it twice: once for the action, once for the
    files) and unpersisted afterwards; later stages read the checkpoint."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


#: Plan nodes that a second pass over the input repeats without a shuffle, a sort or Python.
SCAN_NODES = {"Project", "Filter", "Relation", "RelationV2", "LogicalRDD", "LocalRelation", "Range"}


def scan_only(df: DataFrame) -> bool:
    """Whether the plan is a scan with projections and filters: to run it twice
    (to sample bounds, then to write) costs less than to write it in between."""
    nodes = re.findall(r"^[\s:+|-]*(\w+)", df._jdf.queryExecution().optimizedPlan().toString(), re.M)
    return bool(nodes) and set(nodes) <= SCAN_NODES


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: measured for strings, binaries and collections,
    8 for the rest (and 8 a field for nested ones' own layout)."""
    def of(c: Column, dt: T.DataType) -> Column:
        if isinstance(dt, T.StructType):
            return sum((of(c[f.name], f.dataType) for f in dt.fields), F.lit(8))
        if isinstance(dt, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        if isinstance(dt, T.ArrayType):
            return F.coalesce(F.aggregate(c, F.lit(8).cast("long"), lambda acc, x: acc + of(x, dt.elementType)), F.lit(8))
        if isinstance(dt, T.MapType):
            return of(F.map_keys(c), T.ArrayType(dt.keyType)) + of(F.map_values(c), T.ArrayType(dt.valueType))
        return F.lit(8).cast("long")
    return sum((of(F.col(f"`{f.name}`"), f.dataType).cast("long") for f in df.schema.fields), F.lit(8).cast("long"))


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows and
    ``max_bytes`` measured bytes.

    At most ``max_rows + 1`` rows are taken, written once (reliable checkpoint)
    and measured; within the bound the written rows are the side, so the plan
    above runs once. Beyond it the frame is returned unchanged and the join is a
    shuffle join (AQE may still convert it from real statistics).
    """
    held = cut_lineage(df.limit(max_rows + 1))
    n, size = held.agg(F.count(F.lit(1)), F.sum(_row_bytes(held))).first()
    return F.broadcast(held) if n <= max_rows and (size or 0) <= max_bytes else df


def bounded_values(df: DataFrame, limit: int, what: str) -> list:
    """The rows of ``df`` for the driver (pivot columns, category domains):
    refused with an error beyond ``limit`` rows, never cut short."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} distinct values; raise the limit or group them first")
    return rows


def ticks(col: str | Column, dtype: T.DataType | None = None) -> Column:
    """Integer time ticks for a time column.

    ``TimestampType`` becomes epoch microseconds; integral columns (ns ticks in
    the reference data) are kept as long.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_micros(c.cast("timestamp"))
    if dtype is None:
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("long")


def micros(col: str | Column) -> Column:
    """Epoch microseconds of a timestamp column (NTZ values read as UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def tick_col(df: DataFrame, col: str) -> Column:
    """``ticks`` with the dtype looked up on ``df``."""
    return ticks(col, df.schema[col].dataType)
