"""Final session results on a stream: the same rows however the input is cut into micro-batches.

Spark's session window emits by a watermark that moves between micro-batches. Here, as in
`windflow.operators.windows.final_sessions`, records are judged by their log partition's clock as of themselves.
State is the set of each key's open sessions as disjoint intervals, which a record that comes out of order may
join together. A micro-batch is an ordinary distributed job over slots, not over a key's records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.functions.durations import interval
from windflow.operators.aggregates import present
from windflow.operators.blocks import BLOCK_WIDTH
from windflow.operators.windows import (
    SESSION_BLOCK, as_sessions, is_final, joined_intervals, session_slots, with_stream_time)
from windflow.streaming.sinks import BatchLog
from windflow.streaming.slots import CLOCKS, Slots, advanced, computed_once, reads_once


class ExactSessions:
    """`foreachBatch` function: sessions per log partition and key, emitted once, when nothing can extend them.

    Records of one log partition must arrive in offset order across batches. Rows without key, time or value
    are left out. Each batch rewrites the open sessions: those of about the last two gaps and `grace`.
    """

    def __init__(self, path: str, rows: DataFrame, key: str, ts: str, value: str, gap: str,
                 grace: str = "0 seconds", partition: str = "partition", order: str = "offset",
                 width: int = BLOCK_WIDTH, session_width: int = SESSION_BLOCK):
        self.key, self.ts, self.value, self.gap, self.grace = key, ts, value, gap, grace
        self.partition, self.order, self.width, self.session_width = partition, order, width, session_width
        self.keys = ["log", key]
        self.slots = Slots(f"{path.rstrip('/')}/state")
        self._sessions = T.StructType([
            T.StructField("log", T.StringType()), T.StructField(key, rows.schema[key].dataType),
            T.StructField("first", T.TimestampType()), T.StructField("last", T.TimestampType()),
            T.StructField("sum_power", T.DoubleType()), T.StructField("num_data_points", T.LongType())])
        self._stored = T.StructType([*self._sessions.fields, T.StructField("is_over", T.BooleanType())])
        self.closed = BatchLog(f"{path.rstrip('/')}/closed", self._sessions, ())

    @reads_once
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.closed.is_committed(spark, batch_id):
            return
        clocks_before = self.slots.left_by(spark, "clocks", batch_id - 1, CLOCKS)
        open_before = self.slots.left_by(spark, "sessions", batch_id - 1, self._stored).filter("not is_over")
        rows = present(batch, self.key, self.ts, self.value).select(
            F.col(self.partition).cast("string").alias("log"), F.col(self.order).alias("position"), self.key,
            F.col(self.ts).cast("timestamp").alias("at"), F.col(self.value).cast("double").alias("amount"))
        timed = with_stream_time(rows, "at", "log", "position", self.width).join(clocks_before, "log", "left")
        kept = timed.filter(F.greatest("stream_time", "clock") <
                            F.col("at") + F.expr(interval(self.gap)) + F.expr(interval(self.grace)))
        intervals = session_slots(kept, self.keys, "at", "amount", self.gap).unionByName(
            open_before.select(*self._sessions.names))
        clocks = advanced(self.slots, clocks_before, rows, batch_id)
        with computed_once(intervals) as kept_intervals:
            joined = joined_intervals(kept_intervals, self.keys, self.gap, self.session_width).join(
                clocks, "log").withColumn("is_over", is_final(F.col("last"), F.col("clock"), self.gap, self.grace))
            written = self.slots.write(joined.select(*self._stored.names), "sessions", batch_id, ("is_over",))
        self.closed.write(written.filter("is_over").select(*self._sessions.names), batch_id)

    def results(self, spark: SparkSession) -> DataFrame:
        """The sessions closed so far, with the log partition as `log`."""
        return as_sessions(self.closed.read(spark), self.keys, self.gap)
