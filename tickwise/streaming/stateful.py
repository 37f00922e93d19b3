"""Exact per-row streaming operators on keyed arbitrary state.

``transformWithStateInPandas`` keeps ordered buffers per key; event-time timers
answer every row once, when the watermark says that nothing it depends on can
still arrive, and state goes as soon as no row to come can need it. Results
equal the batch operators on all rows that the watermark has passed; later
rows are dropped by Spark (``rows_dropped`` counts them). ``run_drained`` ends a
bounded stream: it runs the query over what is available, then lets one
end-of-stream mark carry the watermark past everything, so no row is left.

State needs the RocksDB store, which ``stateful_session`` selects. Columns that
reach a processor have plain names: batches come as named tuples.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import moments
from ..functions.moments import rolling_columns
from ..session import ensure_checkpoint_dir

# the process that prepares a stateful operator beside the driver has no shipped package: processors travel whole
for _module in (moments, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
END_OF_STREAM = "9999-12-31 00:00:00"


def stateful_session(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def settled_before(t: np.ndarray, watermark_ms: int) -> np.ndarray:
    """Whether the watermark has passed the microsecond ticks ``t``: Spark keeps
    it in milliseconds, and a timer needs a later one than its own."""
    return t // 1000 + 1 < watermark_ms


#: Rows of a state are kept in blocks, the bytes of an array: one value a batch, not one a row.
ROLLING_BLOCK = np.dtype([("t", "<i8"), ("id", "<i8"), ("v", "<f8"), ("c", "?"), ("own", "?")])
NEAREST_BLOCK = np.dtype([("t", "<i8"), ("id", "<i8")])


def as_block(pdf: pd.DataFrame, kind: np.dtype) -> np.ndarray:
    if pdf["s_id"].isna().any():
        raise ValueError("a row of a stream needs an id")
    out = np.empty(len(pdf), dtype=kind)
    for name in kind.names:
        out[name] = pdf[f"s_{name}"].to_numpy(dtype=kind[name])
    return out


def held_block(state, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(block) for block, in state.get()), dtype=kind)


class RollingRows(StatefulProcessor):
    """Rolling statistics of one (key, bucket): rows of the bucket and the last
    ``wide`` ticks before it. A row is answered when the watermark has passed
    it; the state goes when the watermark has passed the bucket."""

    def __init__(self, windows: Mapping[str, int], bucket: int, include_current: bool, exact_ties: bool, names: tuple[str, str, str],
                 value_col: str, columns: Sequence[str]):
        self.windows, self.bucket, self.flags, self.names = dict(windows), bucket, (include_current, exact_ties), names
        self.value_col, self.columns = value_col, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "block binary")
        self.done = handle.getValueState("done", "watermark long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            fresh = as_block(pdf, ROLLING_BLOCK)
            self.rows.appendValue((fresh.tobytes(),))
            own = fresh["t"][fresh["own"]]
            if len(own):
                self.handle.registerTimer(int(own.min()) // 1000 + 1)
        self.handle.registerTimer((int(key[-1]) + 1) * self.bucket // 1000 + 2)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        before = self.done.get()[0] if self.done.exists() else 0
        held = held_block(self.rows, ROLLING_BLOCK)
        if len(held) and watermark > before:
            held = held[np.lexsort((held["id"], held["t"]))]
            t, own = held["t"].copy(), held["own"]
            passed = settled_before(t, watermark)
            now = np.flatnonzero(own & passed & ~settled_before(t, before))
            if len(now):
                # later rows can't be in the window of a settled one, but equal ticks can
                stats = rolling_columns(t, held["v"].copy(), held["c"], self.windows, *self.flags,
                                        self.names, self.value_col)
                part = pd.DataFrame({**{c: [k] * len(now) for c, k in zip(self.columns, key[:-1])}, "id": held["id"][now], "t_us": t[now],
                                     self.value_col: held["v"][now], **{c: x[now] for c, x in stats.items()}})
                yield part[self.columns].reset_index(drop=True)
            self.done.update((int(watermark),))
            left = t[own & ~passed]
            if len(left):
                self.handle.registerTimer(int(left.min()) // 1000 + 1)
        if settled_before(np.int64((int(key[-1]) + 1) * self.bucket), watermark):
            self.rows.clear()
            self.done.clear()

    def close(self) -> None:
        pass


def rolling_stats_stream(stream: DataFrame, *, id_col: str, time_col: str, value_col: str, windows: Mapping[str, int], delay: str,
                         count_col: str | None = None, keys: Sequence[str] = (), bucket_width: int | None = None,
                         include_current: bool = True, exact_ties: bool = False, mean_name: str = "{v}_roll_mean_{w}",
                         std_name: str = "{v}_roll_std_{w}", count_name: str = "rate_{w}") -> DataFrame:
    """Rolling mean, deviation and count over ``(t - width, t]`` for every
    row of a stream, as W1-W3 give them in batch (same options).

    Widths are microseconds. Time is cut into buckets at least as wide as the
    widest window; a row goes to its bucket and, if a later window can reach
    back to it, to the next one. State is one (key, bucket), so a stream without
    keys, or with a hot one, is spread over its buckets and holds two of them.
    """
    wide = max(int(w) for w in windows.values())
    bucket = int(bucket_width or wide)
    if bucket < wide:
        raise ValueError("bucket_width must be >= the widest window")
    kept = (stream.withWatermark(time_col, delay).where(F.col(time_col) < F.lit(END_OF_STREAM).cast("timestamp"))
            .withColumn("s_t", F.unix_micros(time_col)))
    own = F.expr(f"(s_t - pmod(s_t, {bucket}L)) div {bucket}L")
    here, there = F.struct(own.alias("s_bucket"), F.lit(True).alias("s_own")), F.struct((own + 1).alias("s_bucket"), F.lit(False).alias("s_own"))
    places = F.when(F.col("s_t") > (own + 1) * bucket - wide, F.array(here, there)).otherwise(F.array(here))
    rows = kept.select(*keys, time_col, "s_t", F.col(id_col).cast("long").alias("s_id"), F.col(value_col).cast("double").alias("s_v"),
                       F.col(count_col or value_col).isNotNull().alias("s_c"), F.inline(places))
    names = (mean_name, std_name, count_name)
    stats = [n.format(v=value_col, w=label) for label in windows for n in names]
    shape = T.StructType([*[stream.schema[k] for k in keys], T.StructField("id", T.LongType()), T.StructField("t_us", T.LongType()),
                          *[T.StructField(c, T.DoubleType()) for c in (value_col, *stats)]])
    processor = RollingRows({k: int(w) for k, w in windows.items()}, bucket, include_current, exact_ties, names, value_col, shape.names)
    return rows.groupBy(*keys, "s_bucket").transformWithStateInPandas(processor, shape, "Append", "EventTime").withColumnRenamed("id", id_col)


class NearestRows(StatefulProcessor):
    """As-of enrichment of one key: pending left rows and the right rows that
    one of them, or a left row to come, may need."""

    def __init__(self, tolerance: int, columns: Sequence[str]):
        self.tolerance, self.columns = tolerance, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.left = handle.getListState("left", "block binary")
        self.right = handle.getListState("right", "block binary")

    def due(self, t: np.ndarray | int):
        """Milliseconds at which a left row at ``t`` can be answered."""
        return (t + self.tolerance) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for state, part in ((self.left, pdf[pdf["s_left"]]), (self.right, pdf[~pdf["s_left"]])):
                if len(part):
                    state.appendValue((as_block(part, NEAREST_BLOCK).tobytes(),))
                    # right rows alone must leave in time too
                    self.handle.registerTimer(int(self.due(int(part["s_t"].min()))))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        left, right = (rows[np.lexsort((rows[:, 1], rows[:, 0]))] for rows in (
            held_block(x, NEAREST_BLOCK).view(np.int64).reshape(-1, 2) for x in (self.left, self.right)))
        ready = self.due(left[:, 0]) < watermark
        now, rest = left[ready], left[~ready]
        if len(now):
            at, found = nearest(now[:, 0], right, self.tolerance)
            match = right[at] if len(right) else np.zeros((len(now), 2), dtype=np.int64)
            yield pd.DataFrame({**{c: [k] * len(now) for c, k in zip(self.columns, key)}, "id": now[:, 1], "t_us": now[:, 0],
                                "match_t_us": pd.arrays.IntegerArray(match[:, 0].copy(), ~found),
                                "match_id": pd.arrays.IntegerArray(match[:, 1].copy(), ~found)})[self.columns]
        # left rows still to come are later than the watermark
        oldest = min([(watermark - 2) * 1000, *rest[:1, 0].tolist()]) - self.tolerance
        keep = right[right[:, 0] >= oldest]
        for state, before, after in ((self.left, left, rest), (self.right, right, keep)):
            if len(after) < len(before):
                state.put([(np.ascontiguousarray(after).tobytes(),)]) if len(after) else state.clear()
        waiting = [*rest[:1, 0].tolist(), *(keep[:1, 0] + self.tolerance).tolist()]
        if waiting:
            self.handle.registerTimer(max(int(self.due(min(waiting))), watermark + 1))

    def close(self) -> None:
        pass


def nearest(t: np.ndarray, right: np.ndarray, tolerance: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of ``right`` (sorted by time and id) nearest to each ``t`` within the
    tolerance, and whether there is one; the earlier time, then the smaller id,
    win a tie."""
    if not len(right):
        return np.zeros(len(t), dtype=np.int64), np.zeros(len(t), dtype=bool)
    times = right[:, 0]
    after = np.searchsorted(times, t, side="left")           # first row at or after t
    before = np.maximum(after - 1, 0)
    before = np.searchsorted(times, times[before], side="left")  # first row of that time
    after = np.minimum(after, len(times) - 1)
    take_after = np.abs(times[after] - t) < np.abs(times[before] - t)
    at = np.where(take_after, after, before)
    return at, np.abs(times[at] - t) <= tolerance


def asof_rows_stream(left: DataFrame, right: DataFrame, *, key: str, left_time: str, left_id: str, right_time: str, right_id: str,
                     tolerance: int, delay: str) -> DataFrame:
    """Every left row with the nearest right row of its key within
    ``tolerance`` microseconds (nulls if there is none), answered once. Both
    sides go through one state per key, so rows within the tolerance are never
    joined pair by pair; the right rows kept reach back by the tolerance from
    the oldest pending left row."""
    side = lambda d, t, i, is_left: d.select(F.col(key), F.col(t).alias("s_time"), F.col(i).cast("long").alias("s_id"),
                                             F.lit(is_left).alias("s_left"))
    rows = side(left, left_time, left_id, True).unionByName(side(right, right_time, right_id, False)).withWatermark("s_time", delay)
    rows = rows.where(F.col("s_time") < F.lit(END_OF_STREAM).cast("timestamp")).withColumn("s_t", F.unix_micros("s_time"))
    shape = T.StructType([left.schema[key], *[T.StructField(c, T.LongType()) for c in ("id", "t_us", "match_t_us", "match_id")]])
    got = rows.groupBy(key).transformWithStateInPandas(NearestRows(int(tolerance), shape.names), shape, "Append", "EventTime")
    return got.withColumnsRenamed({"id": left_id, "match_id": right_id})


def with_end_mark(stream: DataFrame, time_col: str, folder: str) -> DataFrame:
    """``stream`` and the end-of-stream marks that appear in ``folder``: rows of
    nulls at END_OF_STREAM, which operators of this module leave out."""
    marks = stream.sparkSession.readStream.schema(f"`{time_col}` timestamp").parquet(folder)
    return stream.unionByName(marks, allowMissingColumns=True)


def rows_dropped(progress: Sequence[Mapping]) -> int:
    """Rows that came after the watermark, over the progress of a query."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in progress for op in p["stateOperators"])


def run_drained(spark: SparkSession, build: Callable[[str], DataFrame], time_col: str, label: str = "drained") -> tuple[DataFrame, int]:
    """(result, late rows) of a bounded stream, to its last row. ``build`` makes
    the query from the folder of end marks (``with_end_mark``). It runs over the
    available input first; then one mark is written and the query goes on from
    its checkpoint, so the watermark passes every row."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")
    marks, out, state = (os.path.join(base, name) for name in ("marks", "out", "state"))
    stateful_session(spark)
    spark.createDataFrame([], f"`{time_col}` timestamp").write.parquet(marks)
    late = 0
    for last in (False, True):
        if last:
            spark.sql(f"SELECT TIMESTAMP '{END_OF_STREAM}' AS `{time_col}`").write.mode("append").parquet(marks)
        df = build(marks)
        q = (df.writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
        q.awaitTermination()
        late += rows_dropped(q.recentProgress)
    return spark.read.schema(df.schema).parquet(out), late
