"""State that a `foreachBatch` job hands from one micro-batch to the next, as tables.

A batch reads what the one before left and writes its own slot, so a repeated batch finds the same state and
gives the same result. Three slots in turns are more than enough, and nothing piles up.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.streaming.sinks import read_if_there

_SLOTS = 3


@contextmanager
def computed_once(df: DataFrame) -> Iterator[DataFrame]:
    """`df`, kept by the executors (in memory, then on disk) while several tables are made of it."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def reads_once(take: Callable[..., None]) -> Callable[..., None]:
    """A `foreachBatch` method that makes several tables of its micro-batch, read and decoded for all of them once."""
    @functools.wraps(take)
    def taken(self, batch: DataFrame, batch_id: int) -> None:
        with computed_once(batch) as kept:
            take(self, kept, batch_id)
    return taken


class Slots:
    """Tables of one job under `path`."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _at(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/slot={batch_id % _SLOTS}"

    def left_by(self, spark: SparkSession, name: str, batch_id: int, schema: T.StructType) -> DataFrame:
        """What batch `batch_id` wrote; nothing before the first."""
        if batch_id < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._at(name, batch_id))

    def again(self, spark: SparkSession, name: str, batch_id: int, schema: T.StructType):
        """The row (with a `batch_id`) that an earlier attempt of this batch has written, if there was one."""
        found = read_if_there(spark, self._at(name, batch_id), schema).first()
        return found if found is not None and found["batch_id"] == batch_id else None

    def write(self, df: DataFrame, name: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> DataFrame:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self._at(name, batch_id))
        return self.left_by(df.sparkSession, name, batch_id, df.schema)


CLOCKS = T.StructType([T.StructField("log", T.StringType()), T.StructField("clock", T.TimestampType())])


def advanced(slots: Slots, before: DataFrame, rows: DataFrame, batch_id: int) -> DataFrame:
    """The largest time seen so far in each log partition: `log, clock`, a row each."""
    return slots.write(before.unionByName(rows.select("log", F.col("at").alias("clock")))
                       .groupBy("log").agg(F.max("clock").alias("clock")).coalesce(1), "clocks", batch_id)


def other_clock(rows: DataFrame, clocks: DataFrame, logs: tuple[int, int] | None, sides: tuple[str, str]) -> DataFrame:
    """`rows` (`side`, `log`) with `other`: how far the other side has come, null while that is not known.

    Without `logs` both sides are partitioned alike, and a row waits for the log partition with its own number.
    Otherwise `logs` says how many log partitions each side has, and a row waits for the slowest.
    """
    first, second = sides
    swapped = F.when(F.col("side") == first, F.lit(second)).otherwise(F.lit(first))
    if logs is None:
        named = F.concat(swapped, F.lit(":"), F.substring_index("log", ":", -1))
        return rows.withColumn("__log", named).join(
            clocks.select(F.col("log").alias("__log"), F.col("clock").alias("other")), "__log", "left").drop("__log")
    wanted = F.when(F.col("__side") == first, logs[0]).otherwise(logs[1])
    slowest = clocks.groupBy(F.substring_index("log", ":", 1).alias("__side")).agg(
        F.min("clock").alias("other"), F.count("*").alias("n")).filter(F.col("n") >= wanted).drop("n")
    return rows.withColumn("__side", swapped).join(slowest, "__side", "left").drop("__side")


def as_side(df: DataFrame, side: str, sides: dict[str, T.StructType], key: str, ts: str, partition: str,
            order: str) -> DataFrame:
    """One side of a two-sided stream: `side, row_key, at, log, position` and a struct column for each side."""
    rows = [F.struct(*df.columns).alias(name) if name == side else F.lit(None).cast(schema).alias(name)
            for name, schema in sides.items()]
    return df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.lit(side).alias("side"), F.col(key).alias("row_key"), F.col(ts).cast("timestamp").alias("at"),
        _log(side, F.col(partition)).alias("log"), F.col(order).cast("bigint").alias("position"), *rows)


def _log(side: str, partition: Column) -> Column:
    return F.concat(F.lit(f"{side}:"), partition.cast("string"))
