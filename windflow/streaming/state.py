"""A job's state as a table, read from its checkpoint while the job rests or runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of the job at `checkpoint`, with the batches whose state can be read."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_table(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None,
                variable: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """The state of one operator after `batch_id`, by default the last: a row a key.

    Columns are those of the key, then those of the value, under `names` where given (key first), and the
    state's `state_partition`. `variable` names the state variable of a state processor. State partitions are
    read by as many tasks, so the table is never in one place.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    stored = reader.load(checkpoint)
    parts = [(side, f.name) for side in ("key", "value") for f in stored.schema[side].dataType.fields]
    if names and len(names) != len(parts):
        raise ValueError(f"{len(names)} names for the columns {[n for _, n in parts]}")
    labels = names or [n for _, n in parts]
    return stored.select(*[F.col(side).getField(n).alias(label) for (side, n), label in zip(parts, labels)],
                         F.col("partition_id").alias("state_partition"))
