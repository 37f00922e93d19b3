"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder known, package importable in Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    # whole texts travel in these batches: few rows keep a worker's memory small where texts are long
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: the lineage is cut by files that every executor can read, so a
    lost executor neither recomputes the plan nor sees other values in it. The
    folder goes when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def with_text(df: DataFrame, text: str = "text", out: str = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(F.col(text), F.lit("")).alias(out)


def global_row_number(df: DataFrame, order: list[str], out: str = "row_number") -> DataFrame:
    """Rows numbered from 0 in the total order of ``order`` (nulls first).

    A range exchange sorts the rows, each is tagged with (partition, position)
    and written once; partition sizes (one row per partition) become offsets.
    No task sees more than its range. Rows equal in ``order`` take neighbouring
    numbers in any order, so ``order`` must hold every column that matters; a
    scan-order column spreads such rows over several ranges.
    """
    keys = [F.col(f"`{c}`") for c in order]
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = (tied.repartitionByRange(*keys, F.col("__tie")).sortWithinPartitions(*keys, "__tie").drop("__tie")
              .withColumn("__at", F.monotonically_increasing_id()))
    held = materialise(ranged).withColumn("__part", F.shiftright("__at", 33))
    sizes = held.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    # one row per partition: bounded by the partition count, not by the data
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    low = F.lit((1 << 33) - 1)
    return (held.join(F.broadcast(offsets), "__part")
            .withColumn(out, F.col("__offset") + F.col("__at").bitwiseAND(low))
            .drop("__part", "__at", "__offset"))


def worker_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def first_by_hash(rows: DataFrame, key: Column, n: int) -> DataFrame:
    """A part of ``rows`` that holds the ``n`` rows of smallest ``key`` (a 64-bit
    hash) and not many more, so that sorting them out doesn't gather ``n`` rows
    of every task: two counts and a threshold. All rows if repeated keys leave
    less than ``n`` below it."""
    total = rows.count()
    if total <= 2 * n:
        return rows
    share = min(1.0, (1.2 * n + 6 * n ** 0.5) / total)
    below = rows.where(key < F.lit(-(1 << 63) + int(share * ((1 << 64) - 1))))
    return below if below.count() >= n else rows
