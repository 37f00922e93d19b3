"""Streaming operators on the smallest driver table (availableNow runs)."""

from pyspark.sql import functions as F

from conftest import SF
from tickwise.streaming import stream as X


def test_tumbling_counts_equal_batch_for_closed_windows(spark):
    s = X.event_time(X.table_stream(spark, SF, "events"))
    out = X.run_available(X.tumbling_counts(s, "event_time", "event_type", "1 hour", "2 hours"), "append", "t")
    got = {(r.window_start, r.event_type): r.n for r in out.collect()}
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    wm = ev.agg(F.max("t")).first()[0] - 2 * 3_600_000_000
    h = 3_600_000_000
    b = (ev.withColumn("ws", (F.col("t") / h).cast("long") * h).groupBy("ws", "event_type").count()
           .where(F.col("ws") + h <= wm).collect())
    assert got == {(r.ws, r.event_type): r["count"] for r in b}


def test_dedupe_and_sessions(spark):
    s = X.event_time(X.table_stream(spark, SF, "events"))
    d = X.run_available(X.dedupe_stream(s, "user_id", "event_time", "1 hour").select("user_id"), "append", "d")
    assert d.count() == spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    ss = X.run_available(X.session_counts(s, "event_time", "user_id", "30 minutes", "1 hour"), "append", "s")
    assert ss.where(F.col("session_end") <= F.col("session_start")).count() == 0


def test_stream_asof_matches_batch_for_settled_rows(spark):
    """Rows whose event time is older than the final watermark minus the
    tolerance are settled: they must equal the batch nearest-within-tolerance."""
    from tickwise.operators.asof import asof_join
    from tickwise.session import micros
    s = X.event_time(X.table_stream(spark, SF, "events"))
    left = s.where(F.col("event_type") != "error").select("event_id", "user_id", "event_time")
    right = s.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("err_id"), "user_id", F.col("event_time").alias("err_time"))
    st = X.run_available(X.asof_enrich_stream(left, right, "user_id", "event_time", "err_time", "event_id",
                                              "6 hours", "2 hours", ["err_id"]), "append", "x4t")
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("t_us", micros("ts"))
    # the query watermark is the minimum over both inputs (max event time - delay)
    last = ev.groupBy(F.col("event_type") == "error").agg(F.max("t_us").alias("m")).collect()
    wm = min(r.m for r in last) - 2 * 3_600_000_000
    bl = ev.where(F.col("event_type") != "error").select("event_id", "user_id", "t_us")
    br = ev.where(F.col("event_type") == "error").select(F.col("event_id").alias("err_id"), "user_id",
                                                         F.col("t_us").alias("err_t"))
    batch = asof_join(bl, br, on="t_us", right_on="err_t", by="user_id", tolerance=6 * 3_600_000_000,
                      right_tie="err_id")
    settled = wm - 7 * 3_600_000_000   # rows wait for watermark > t + tolerance
    a = {r.event_id: r.err_id for r in st.where(F.col("t_us") < settled).collect()}
    b = {r.event_id: r.err_id for r in batch.where(F.col("t_us") < settled).collect()}
    assert a == b and len(a) > 0


def test_stream_reads_every_file_of_a_table(spark, tmp_dir):
    """A table that is a folder of part files, met in several batches."""
    from tickwise.streaming.stream import run_available, table_stream
    src = spark.read.parquet(f"{SF}/events.parquet")
    src.repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    for per_trigger in (None, 1):
        got = run_available(table_stream(spark, tmp_dir, "events", per_trigger))
        assert got.count() == src.count()
    assert run_available(table_stream(spark, SF, "events")).count() == src.count()
