"""Every update of a running average on a stream: a row for each record, as the changelog topic has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.operators.aggregates import present, running_average
from windflow.operators.blocks import BLOCK_WIDTH
from windflow.streaming.sinks import BatchLog
from windflow.streaming.slots import Slots, reads_once


class RunningAverages:
    """`foreachBatch` function: `running_average` continued from batch to batch.

    Carried over is one row per key (sum and number). Inside a batch a key is spread over blocks of offsets, so
    a hot key is not one task. Records of a key must arrive in `order` across batches, as those of one log partition do.
    """

    def __init__(self, path: str, rows: DataFrame, key: str, value: str, order: str = "offset",
                 width: int = BLOCK_WIDTH):
        self.key, self.value, self.order, self.width = key, value, order, width
        self.columns = rows.columns
        self.slots = Slots(f"{path.rstrip('/')}/state")
        key_type = rows.schema[key].dataType
        self._totals = T.StructType([T.StructField(key, key_type), T.StructField("sum_before", T.DoubleType()),
                                     T.StructField("n_before", T.LongType())])
        self.changes = BatchLog(f"{path.rstrip('/')}/changes", T.StructType([
            *rows.schema.fields, T.StructField("sum_power", T.DoubleType()),
            T.StructField("num_data_points", T.LongType()), T.StructField("average", T.DoubleType())]), ())

    @reads_once
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.changes.is_committed(spark, batch_id):
            return
        before = self.slots.left_by(spark, "totals", batch_id - 1, self._totals)
        added = present(batch, self.key, self.value).groupBy(self.key).agg(
            F.sum(F.col(self.value).cast("double")).alias("sum_before"), F.count(self.value).alias("n_before"))
        self.slots.write(before.unionByName(added).groupBy(self.key).agg(
            F.sum("sum_before").alias("sum_before"), F.sum("n_before").alias("n_before")), "totals", batch_id)
        here = running_average(batch, self.key, self.value, self.order, width=self.width).drop("average")
        whole = (here.join(before, self.key, "left")
                 .withColumn("sum_power", F.col("sum_power") + F.coalesce("sum_before", F.lit(0.0)))
                 .withColumn("num_data_points", F.col("num_data_points") + F.coalesce("n_before", F.lit(0)))
                 .withColumn("average", F.col("sum_power") / F.col("num_data_points")))
        self.changes.write(whole, batch_id)

    def results(self, spark: SparkSession) -> DataFrame:
        """All updates so far."""
        return self.changes.read(spark).drop("batch_id")
