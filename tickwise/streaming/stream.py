"""Structured Streaming forms of batch operators.

Sources are file streams over the driver tables (schema taken from a batch
read, never inferred per file). Stateful operators carry watermarks so state
is bounded: windows and sessions are emitted once the watermark passes them,
and rows later than the watermark are dropped (the documented difference from
the batch forms). ``run_available`` drives a query with the ``availableNow``
trigger into a Parquet sink under the shared checkpoint folder and returns
the written table.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of the table ``{sf_dir}/{name}.parquet``, whether it is one
    file or a folder of part files (schema from the batch reader). A streaming
    source reads folders, so a single file is picked out of its folder by name."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    folder = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath).isDirectory()
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path) if folder else r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def run_available(df: DataFrame, output_mode: str = "append", label: str = "stream") -> DataFrame:
    """Run a streaming DataFrame to completion (availableNow) into Parquet in a
    fresh folder under the checkpoint directory; return the batch result."""
    spark = df.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    q = (df.writeStream.format("parquet").outputMode(output_mode).option("path", out)
           .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def event_time(df: DataFrame, ts: str = "ts", out: str = "event_time") -> DataFrame:
    """Event-time column of ``TimestampType`` (NTZ values read as UTC)."""
    return df.withColumn(out, F.col(ts).cast("timestamp"))


# X1
def score_stream(stream: DataFrame, model, keep: list[str], out_cols: list[str]) -> DataFrame:
    """Stateless scoring of each micro-batch with a fitted model."""
    return model.transform(stream).select(*keep, *out_cols)


# X2
def tumbling_counts(stream: DataFrame, time_col: str, key: str, width: str, delay: str,
                    value: str | None = None) -> DataFrame:
    """Per (window, key) count (and mean of ``value``), append mode."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.avg(value).alias("mean_value"))
    return (stream.withWatermark(time_col, delay).groupBy(F.window(time_col, width).alias("w"), key)
                  .agg(*aggs)
                  .select(F.unix_micros("w.start").alias("window_start"), F.unix_micros("w.end").alias("window_end"),
                          key, *[a for a in ("n", "mean_value") if a != "mean_value" or value]))


# X3
def sliding_stats(stream: DataFrame, time_col: str, value: str, width: str, slide: str, delay: str) -> DataFrame:
    """Sliding-window mean / sample std / count (approximation of the per-row
    rolling features at window granularity)."""
    return (stream.withWatermark(time_col, delay).groupBy(F.window(time_col, width, slide).alias("w"))
                  .agg(F.avg(value).alias("mean_value"), F.stddev_samp(value).alias("std_value"),
                       F.count(value).alias("n"))
                  .select(F.unix_micros("w.start").alias("window_start"), F.unix_micros("w.end").alias("window_end"),
                          "mean_value", "std_value", "n"))


# X4
def asof_enrich_stream(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                       left_id: str, tolerance: str, delay: str, right_cols: list[str]) -> DataFrame:
    """Bounded nearest-in-time enrichment of a stream by another stream:
    watermarked left outer join on key equality and ``|dt| <= tolerance``, then
    per left row the right row with the smallest (|dt|, right time). Unmatched
    left rows are emitted with nulls once the watermark passes."""
    lw = left.withWatermark(left_time, delay)
    rw = right.withWatermark(right_time, delay).withColumnRenamed(key, f"__r_{key}")
    cond = ((F.col(key) == F.col(f"__r_{key}"))
            & (F.col(right_time) >= F.col(left_time) - F.expr(f"INTERVAL {tolerance}"))
            & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {tolerance}")))
    j = lw.join(rw, cond, "leftOuter")
    dist = F.abs(F.unix_micros(right_time) - F.unix_micros(left_time))
    best = F.min_by(F.struct(*[F.col(c) for c in [right_time, *right_cols]]),
                    F.struct(dist, F.unix_micros(right_time)))
    return (j.groupBy(left_time, left_id, key).agg(best.alias("m"))
             .select(left_id, key, F.unix_micros(left_time).alias("t_us"),
                     F.unix_micros(f"m.{right_time}").alias("match_t_us"), *[f"m.{c}" for c in right_cols]))


# X5
def dedupe_stream(stream: DataFrame, key: str, time_col: str, delay: str) -> DataFrame:
    """Drop repeated ``key`` values within the watermark delay."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def session_counts(stream: DataFrame, time_col: str, key: str, gap: str, delay: str) -> DataFrame:
    """Per key sessions (gap-separated) with event counts, append mode."""
    return (stream.withWatermark(time_col, delay)
                  .groupBy(F.session_window(time_col, gap).alias("s"), key)
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(key, F.unix_micros("s.start").alias("session_start"),
                          F.unix_micros("s.end").alias("session_end"), "n"))
