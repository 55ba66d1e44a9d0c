"""Record mapping, filters, branches and partition placement."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.functions.hashing import HEAVY_PARTITIONS, heavy_partition
from windflow.schemas import TOPICS

# Fixed value: the power, in watts, that separates little from much wind.
WIND_LIMIT = 10_000.0

Mapper = Callable[[Column], Column]
Predicate = Callable[[Column], Column]


def map_values(df: DataFrame, mapper: Mapper, value: str = "value") -> DataFrame:
    """Replace `value` by an expression over it; the key stays, so nothing is shuffled."""
    return df.withColumn(value, mapper(F.col(value)))


def filter_records(df: DataFrame, predicate: Predicate, value: str = "value") -> DataFrame:
    return df.filter(predicate(F.col(value)))


def select_key(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Give the records another key. Spark shuffles when, and only if, a later operator needs it."""
    return df.withColumn(name, key)


def flat_map(df: DataFrame, outputs: Sequence[Column], name: str = "record") -> DataFrame:
    """One record to several: each of the equally typed structs in `outputs` becomes a row."""
    return df.withColumn(name, F.explode(F.array(*outputs)))


def little_wind(df: DataFrame, power: str = "current_power", limit: float = WIND_LIMIT) -> DataFrame:
    return df.filter(F.col(power) < limit)


def much_wind(df: DataFrame, power: str = "current_power", limit: float = WIND_LIMIT) -> DataFrame:
    return df.filter(F.col(power) > limit)


def route(df: DataFrame, branches: Sequence[tuple[str, Column]], default: str | None = None,
          topic: str = "topic") -> DataFrame:
    """Tag each record with the topic of the first branch whose condition holds, in one pass.

    Records no branch takes go to `default`, or drop when there is none.
    """
    if not branches:
        raise ValueError("at least one branch is needed")
    tag = None
    for name, condition in branches:
        tag = F.when(condition, name) if tag is None else tag.when(condition, name)
    tag = tag.otherwise(F.lit(default).cast("string"))
    routed = df.withColumn(topic, tag)
    return routed if default is not None else routed.filter(F.col(topic).isNotNull())


def route_wind(df: DataFrame, power: str = "current_power", limit: float = WIND_LIMIT) -> DataFrame:
    """Little wind below the limit, everything else to much wind."""
    return route(df, [(TOPICS["little_wind"], F.col(power) < limit)], default=TOPICS["much_wind"])


def partition_by(df: DataFrame, partitioner: Callable[[Column], Column], key: str = "key") -> DataFrame:
    """Set `partition` by a custom partitioner: a function from the key column to an int column."""
    return df.withColumn("partition", partitioner(F.col(key)).cast("int"))


def partition_heavy(df: DataFrame, partitions: int, heavy: int = HEAVY_PARTITIONS,
                    key: str = "key", hash_name: str = "murmur2") -> DataFrame:
    """Set `partition`: heavy producers to the first `heavy` partitions, others to the rest.

    Keys must be text. Records without a key get no partition: see `unkeyed`.
    """
    if not isinstance(df.schema[key].dataType, T.StringType):
        raise ValueError("keys must be text")
    return partition_by(df, lambda k: heavy_partition(k, partitions, heavy, hash_name=hash_name), key)


def unkeyed(df: DataFrame, key: str = "key") -> DataFrame:
    """The records a keyed operator drops: the reject output for missing keys."""
    return df.filter(F.col(key).isNull())


def place(df: DataFrame, partitions: int, partition: str = "partition") -> DataFrame:
    """Move every record into the Spark partition that its `partition` column names."""
    return df.repartitionById(partitions, F.col(partition))


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """`df`, failing the job at the first row for which `condition` is not true."""
    return df.filter(F.assert_true(condition, message).isNull())


def first_n(df: DataFrame, n: int, order: str | Sequence[str] = "offset") -> DataFrame:
    """The first `n` records in `order`: each task keeps its own `n`, then they are merged."""
    orders = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*orders).limit(n)
