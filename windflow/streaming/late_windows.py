"""Final window results on a stream, with the exact rule for late records.

Spark's watermark moves between micro-batches, so it lets in a record that is late by less than a
batch. Here each log partition's clock advances record by record, as in
`windflow.operators.windows.final_windows`, and is handed from batch to batch. A micro-batch is an
ordinary distributed job: a hot log partition is spread over blocks of offsets, and windows are
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.functions.durations import interval
from windflow.operators.aggregates import present
from windflow.operators.blocks import BLOCK_WIDTH
from windflow.operators.windows import open_windows, with_stream_time
from windflow.schemas import struct_of
from windflow.streaming.sinks import BatchLog
from windflow.streaming.slots import reads_once


# A batch reads the state of the one before and replaces its own: three slots are more than enough.
_SLOTS = 3


class ExactFinalWindows:
    """`foreachBatch` function: sums per key and window, emitted once, when the window closes.

    Windows tumble, or hop by `slide`; then records are combined per pane first, and each counts in those of its
    windows that are still open.

    Under `path`, `windows/slot=N` and `clocks/slot=N` hold the state after a batch, in turns, so
    the state does not pile up; closed windows go to the `BatchLog` `closed`. A batch reads only
    what the one before left, so a repeated batch gives the same result. Records of one log
    partition must arrive in offset order across batches. One `path` belongs to one checkpoint.
    """

    def __init__(self, path: str, key: str, ts: str, value: str, size: str,
                 grace: str = "0 seconds", partition: str = "partition", order: str = "offset",
                 width: int = BLOCK_WIDTH, key_type: T.DataType = T.StringType(), slide: str | None = None):
        self.path, self.key, self.ts, self.value = path.rstrip("/"), key, ts, value
        self.size, self.grace, self.slide = size, grace, slide or size
        self.partition, self.order, self.width = partition, order, width
        row = T.StructType([
            T.StructField("log_partition", T.IntegerType()), T.StructField(key, key_type),
            T.StructField("window_start", T.TimestampType()),
            T.StructField("window_end", T.TimestampType()),
            T.StructField("sum_power", T.DoubleType()),
            T.StructField("num_data_points", T.LongType())])
        self.closed = BatchLog(f"{self.path}/closed", row, partition_by=())
        self._windows = T.StructType([*row.fields, T.StructField("is_closed", T.BooleanType())])
        self._clocks = struct_of("log_partition INT, clock TIMESTAMP")

    def _slot(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/slot={batch_id % _SLOTS}"

    def _left_by(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """The open windows and the clocks after batch `batch_id`; none before the first."""
        if batch_id < 0:
            return (spark.createDataFrame([], self.closed.schema),
                    spark.createDataFrame([], self._clocks))
        windows = spark.read.schema(self._windows).parquet(self._slot("windows", batch_id))
        return (windows.filter(~F.col("is_closed")).drop("is_closed"),
                spark.read.schema(self._clocks).parquet(self._slot("clocks", batch_id)))

    @reads_once
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.closed.is_committed(spark, batch_id):
            return
        open_before, clocks_before = self._left_by(spark, batch_id - 1)
        rows = (present(batch, self.key, self.ts, self.value)
                .withColumn("log_partition", F.col(self.partition).cast("int"))
                .select("log_partition", self.order, self.key, self.ts, self.value))
        timed = (with_stream_time(rows, self.ts, "log_partition", self.order, self.width)
                 .join(clocks_before, "log_partition", "left")
                 .withColumn("stream_time", F.greatest("stream_time", "clock")))
        grace = F.expr(interval(self.grace))
        added = open_windows(timed, ["log_partition", self.key], self.ts, self.value, self.size, self.slide, self.grace)
        merged = (open_before.unionByName(added)
                  .groupBy("log_partition", self.key, "window_start", "window_end")
                  .agg(F.sum("sum_power").alias("sum_power"),
                       F.sum("num_data_points").alias("num_data_points")))
        # One row per log partition.
        (clocks_before.unionByName(rows.select("log_partition", F.col(self.ts).alias("clock")))
         .groupBy("log_partition").agg(F.max("clock").alias("clock"))
         .coalesce(1).write.mode("overwrite").parquet(self._slot("clocks", batch_id)))
        clocks = spark.read.schema(self._clocks).parquet(self._slot("clocks", batch_id))
        (merged.join(clocks, "log_partition")
         .withColumn("is_closed", F.col("window_end") + grace <= F.col("clock"))
         .select(*self._windows.names)
         .write.mode("overwrite").partitionBy("is_closed").parquet(self._slot("windows", batch_id)))
        written = spark.read.schema(self._windows).parquet(self._slot("windows", batch_id))
        self.closed.write(written.filter("is_closed"), batch_id)

    def results(self, spark: SparkSession) -> DataFrame:
        """The windows closed so far."""
        return (self.closed.read(spark).drop("batch_id")
                .withColumn("average", F.col("sum_power") / F.col("num_data_points")))
