"""Ordered scans over a key without putting the whole key into one task.

A running sum, a running clock or "the newest version before this row" are windows ordered by
offset. Partitioned by key alone, a key that holds a third of all rows becomes one task. Here rows
are partitioned by (key, block), a block being a fixed stretch of offsets or of time, and what earlier
blocks hand over is summed up per block first. Offsets are unique within a log partition, so a group
of a block of offsets has at most `width` rows per log partition the key lives in; a group of a block
of time has what a key sends in that time. Choose `width` by the busiest key.

The rows are shuffled once, on (key, block). The block totals are combined on the map side and are
shuffled as one small row per (key, block).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "__block"
# Offsets in a block, and microseconds where rows are ordered by time.
BLOCK_WIDTH, BLOCK_MICROS = 1 << 16, 3_600_000_000


def with_block(df: DataFrame, order: str, width: int | None = None) -> DataFrame:
    """`df` with the block of each row's `order`, a whole number or a time; `width` as in `BLOCK_WIDTH`
    or `BLOCK_MICROS`."""
    if isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)):
        at = F.unix_micros(F.col(order).cast("timestamp"))
        return df.withColumn(BLOCK, F.floor(at / F.lit(int(width or BLOCK_MICROS))))
    return df.withColumn(BLOCK, F.floor(F.col(order) / F.lit(int(width or BLOCK_WIDTH))))


def so_far(keys: Sequence[str], order: str, ties: Sequence[str] = ()):
    """The rows of this block up to the current one."""
    return (Window.partitionBy(*keys, BLOCK).orderBy(order, *ties)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


Totals = dict[str, tuple[Column, Callable[[Column], Column]]]


def from_earlier_blocks(blocked: DataFrame, keys: Sequence[str], earlier: Totals,
                        overall: Totals | None = None) -> DataFrame:
    """Per (keys, block), what all earlier blocks hand over.

    `earlier` maps an output name to (aggregate over one block, aggregate over blocks); `overall`
    does the same for outputs that span all blocks of the keys, later ones included.
    """
    overall = overall or {}
    per_block = blocked.groupBy(*keys, BLOCK).agg(
        *[a.alias(n) for n, (a, _) in (earlier | overall).items()])
    before = (Window.partitionBy(*keys).orderBy(BLOCK)
              .rowsBetween(Window.unboundedPreceding, -1))
    whole = (Window.partitionBy(*keys).orderBy(BLOCK)
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per_block.select(
        *keys, BLOCK,
        *[over(F.col(n)).over(before).alias(n) for n, (_, over) in earlier.items()],
        *[over(F.col(n)).over(whole).alias(n) for n, (_, over) in overall.items()])


def row_index(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (),
              name: str = "__index", width: int | None = None) -> DataFrame:
    """`df` with the 0-based position of each row within its key. Rows with a null key drop."""
    blocked = with_block(df, order, width)
    before = from_earlier_blocks(blocked, keys, {"__rows_before": (F.count(F.lit(1)), F.sum)})
    local = F.row_number().over(Window.partitionBy(*keys, BLOCK).orderBy(order, *ties))
    return (blocked.withColumn("__local", local)
            .join(before, [*keys, BLOCK])
            .withColumn(name, F.coalesce("__rows_before", F.lit(0)) + F.col("__local") - 1)
            .drop("__local", "__rows_before", BLOCK))
