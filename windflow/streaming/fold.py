"""A user-defined fold per key on a stream.

`MergedFolds` takes a `Fold` of column expressions that can merge neighbouring stretches; `fold_stream` takes
initial value and aggregator as Python functions, which need a key's rows in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from windflow.operators.aggregates import Fold, custom_fold, latest_by_key
from windflow.operators.blocks import BLOCK_WIDTH
from windflow.streaming.sinks import BatchLog
from windflow.streaming.slots import Slots, reads_once

Initializer = Callable[[], tuple]
Aggregator = Callable[[str, pd.DataFrame, tuple], tuple]


class _Fold(StatefulProcessor):
    def __init__(self, initializer: Initializer, aggregator: Aggregator, state: T.StructType,
                 key: str, order: str):
        self.initializer, self.aggregator = initializer, aggregator
        self.schema, self.key, self.order = state, key, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("accumulator", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        acc = tuple(self.state.get()) if self.state.exists() else self.initializer()
        # Spark does not promise an order within a key, so its rows of this micro-batch are sorted.
        batch = pd.concat(list(rows)).sort_values(self.order)
        acc = self.aggregator(key[0], batch, acc)
        self.state.update(acc)
        yield pd.DataFrame([(key[0], *acc)], columns=[self.key, *self.schema.names])

    def close(self) -> None:
        pass


def fold_stream(df: DataFrame, key: str, initializer: Initializer, aggregator: Aggregator,
                state: T.StructType, order: str = "offset") -> DataFrame:
    """The accumulator of each key a micro-batch touched, to be written in update mode.

    `aggregator(key, rows, acc)` gets the key's new rows in `order` as one pandas frame, so it can
    work on whole columns, and returns the next accumulator, a tuple of the fields of `state`. A
    key's rows of one micro-batch are held in one task: bound it with `max_files` or `max_records`
    at the source. Use `average_by_key` or another built-in aggregate where one fits.
    """
    output = T.StructType([df.schema[key], *state.fields])
    return (df.filter(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(
        statefulProcessor=_Fold(initializer, aggregator, state, key, order),
        outputStructType=output, outputMode="Update", timeMode="None"))


class MergedFolds:
    """`foreachBatch` function: `custom_fold` continued from batch to batch.

    A batch is folded per (key, block of `order`) and merged in rounds by built-in functions, so a hot key is
    spread over tasks; state is one accumulator a key. `changes` holds the accumulator of each key that a batch
    touched. Records of a key must arrive in `order` across batches, as those of one log partition do.
    """

    def __init__(self, path: str, rows: DataFrame, key: str, fold: Fold, inputs: Sequence[str],
                 order: str = "offset", ties: Sequence[str] = (), name: str = "result", width: int = BLOCK_WIDTH):
        self.key, self.fold, self.inputs, self.name = key, fold, inputs, name
        self.order, self.ties, self.width = order, ties, width
        self.slots = Slots(f"{path.rstrip('/')}/state")
        accumulator = rows.select(fold.zero.alias(name)).schema[name].dataType
        self._kept = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField(name, accumulator)])
        self.changes = BatchLog(f"{path.rstrip('/')}/changes", self._kept, ())

    @reads_once
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.changes.is_committed(spark, batch_id):
            return
        here = custom_fold(batch, self.key, self.fold, self.inputs, self.order, self.ties, "__here", self.width)
        before = self.slots.left_by(spark, "accumulators", batch_id - 1, self._kept)
        whole = before.join(here, self.key, "full").select(
            self.key, F.when(F.col("__here").isNull(), F.col(self.name)).when(F.col(self.name).isNull(), F.col("__here"))
            .otherwise(self.fold.merge(F.col(self.name), F.col("__here"))).alias(self.name),
            F.col("__here").isNotNull().alias("is_new"))
        written = self.slots.write(whole, "accumulators", batch_id, ("is_new",))
        self.changes.write(written.filter("is_new").select(self.key, self.name), batch_id)

    def results(self, spark: SparkSession) -> DataFrame:
        """The newest accumulator of each key."""
        return latest_by_key(self.changes.read(spark), self.key, "batch_id").drop("batch_id")
