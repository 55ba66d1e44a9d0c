"""Counts, averages, latest values and folds per key.

All of them ignore rows whose key or value is null, as keyed stream aggregations do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windflow.operators.blocks import (
    BLOCK_WIDTH, from_earlier_blocks, row_index, so_far, with_block, BLOCK)


def present(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def count_by_key(df: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """Records per key; `value` names the payload whose absence makes a record not count."""
    return (present(df, key, *([value] if value else []))
            .groupBy(key).agg(F.count(F.lit(1)).alias("count")))


def average_by_key(df: DataFrame, key: str | Sequence[str], value: str) -> DataFrame:
    """Sum, number and average per key: the final table, or an updating one on a stream."""
    keys = [key] if isinstance(key, str) else list(key)
    return (present(df, *keys, value).groupBy(*keys)
            .agg(F.sum(value).alias("sum_power"), F.count(value).alias("num_data_points"))
            .withColumn("average", F.col("sum_power") / F.col("num_data_points")))


def running_average(df: DataFrame, key: str, value: str, order: str = "offset",
                    ties: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """`df` with sum, number and average of the key's values up to each row (batch).

    This is the changelog of `average_by_key`: one row per update, in `order`, which must be
    unique within a key together with `ties`.
    """
    blocked = with_block(present(df, key, value), order, width)
    window = so_far([key], order, ties)
    before = from_earlier_blocks(blocked, [key], {
        "__sum_before": (F.sum(value), F.sum), "__n_before": (F.count(value), F.sum)})
    return (blocked.withColumn("__sum", F.sum(value).over(window))
            .withColumn("__n", F.count(value).over(window))
            .join(before, [key, BLOCK])
            .withColumn("sum_power", F.coalesce("__sum_before", F.lit(0.0)) + F.col("__sum"))
            .withColumn("num_data_points", F.coalesce("__n_before", F.lit(0)) + F.col("__n"))
            .withColumn("average", F.col("sum_power") / F.col("num_data_points"))
            .drop("__sum", "__n", "__sum_before", "__n_before", BLOCK))


def moving_average(df: DataFrame, key: str, value: str, n: int, order: str = "offset",
                   ties: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """`df` with `moving_average`, the mean of the key's last `n` values at each row (batch).

    Rows get their position within the key; blocks of positions are averaged on their own, each
    with a copy of the `n - 1` rows before it.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    size = max(width or BLOCK_WIDTH, n)
    indexed = row_index(present(df, key, value), [key], order, ties, width=width)
    home = F.expr(f"__index div {size}L")
    from_end = F.lit(size) - F.pmod(F.col("__index"), F.lit(size))
    blocks = F.when(from_end < n, F.array(home, home + 1)).otherwise(F.array(home))
    window = Window.partitionBy(key, BLOCK).orderBy("__index").rowsBetween(-(n - 1), 0)
    return (indexed.withColumn(BLOCK, F.explode(blocks))
            .withColumn("moving_average", F.avg(value).over(window))
            .filter(F.col(BLOCK) == home)
            .drop("__index", BLOCK))


def latest_by_key(df: DataFrame, key: str, order: str | Sequence[str] = "offset",
                  tombstone: Column | None = None) -> DataFrame:
    """A changelog as a table: the newest row of each key, keys deleted last left out.

    `tombstone` says which rows delete their key. Deletions take part in finding the newest row. Of rows
    of a key with equal `order` one is taken; rows whose first `order` is null are left out.

    The largest first `order` per key is found by a hash aggregate over two narrow columns, combined
    on the map side, and only the rows that carry it are ranked by the others.
    """
    orders = [order] if isinstance(order, str) else list(order)
    dead = F.coalesce(tombstone, F.lit(False)) if tombstone is not None else F.lit(False)
    rows = present(df, key, orders[0]).withColumn("__dead", dead)
    top = rows.groupBy(key).agg(F.max(orders[0]).alias("__top")).withColumnRenamed(key, "__of")
    last = rows.join(top, (F.col(key) == F.col("__of")) & (F.col(orders[0]) == F.col("__top")))
    # Ties are few: what is left is about a row a key.
    ranked = Window.partitionBy(key).orderBy(*[F.col(o).desc() for o in orders])
    return (last.withColumn("__rank", F.row_number().over(ranked))
            .filter((F.col("__rank") == 1) & ~F.col("__dead")).select(*df.columns))


@dataclass(frozen=True)
class Fold:
    """A fold over a key's rows in order, written with column expressions.

    `zero` is the empty accumulator, `step(acc, row)` adds a row (a struct), `merge(a, b)` joins
    the accumulators of two neighbouring stretches, the earlier one first. All three give columns
    of one type, and `merge(fold(x), fold(y)) = fold(x + y)` must hold, with `zero` neutral.
    """

    zero: Column
    step: Callable[[Column, Column], Column]
    merge: Callable[[Column, Column], Column]


# Accumulators of neighbouring blocks that one group merges.
NEIGHBOURS = 1024


def custom_fold(df: DataFrame, key: str, fold: Fold, inputs: Sequence[str], order: str = "offset",
                ties: Sequence[str] = (), name: str = "result", width: int | None = None,
                neighbours: int = NEIGHBOURS, rounds: int = 1) -> DataFrame:
    """`fold` over each key in `order`: one row per key (batch).

    Rows are folded per (key, block of `order`). Then, in each of `rounds`, the accumulators of up to
    `neighbours` blocks in a row are merged in order, and at last those of a key: a task holds one block's
    rows of a key, or so many accumulators. Rows with equal `order` and `ties` are folded in the order of
    their inputs.
    """
    rows = with_block(present(df, key, order).select(
        F.col(key), F.col(order), *[F.col(c) for c in dict.fromkeys([*ties, *inputs]) if c not in (key, order)]),
        order, width)
    position = F.struct(F.col(order).alias("__order"), *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(ties)])
    merged = (rows.groupBy(key, BLOCK)
              .agg(F.sort_array(F.collect_list(F.struct(position.alias("__at"), F.struct(*inputs).alias("__row"))))
                   .alias("__rows"))
              .select(key, BLOCK, F.aggregate(
                  "__rows", fold.zero, lambda a, x: fold.step(a, x["__row"])).alias("__acc")))
    for last in [False] * rounds + [True]:
        home = F.lit(0) if last else F.floor(F.col(BLOCK) / F.lit(neighbours))
        merged = (merged.groupBy(key, home.alias("__home"))
                  .agg(F.sort_array(F.collect_list(F.struct(BLOCK, "__acc"))).alias("__accs"))
                  .select(key, F.col("__home").alias(BLOCK), F.aggregate(
                      "__accs", fold.zero, lambda a, x: fold.merge(a, x["__acc"])).alias("__acc")))
    return merged.select(key, F.col("__acc").alias(name))


def largest_rise_fold(value: str) -> Fold:
    """Number, first and last value, and the largest rise from one row to the next."""
    def state(n: Column, first: Column, last: Column, rise: Column) -> Column:
        return F.struct(n.alias("num_data_points"), first.alias("first"), last.alias("last"), rise.alias("rise"))

    def merge(a: Column, b: Column) -> Column:
        return state(a["num_data_points"] + b["num_data_points"], F.coalesce(a["first"], b["first"]),
                     F.coalesce(b["last"], a["last"]), F.greatest(a["rise"], b["rise"], b["first"] - a["last"]))

    none = F.lit(None).cast("double")
    return Fold(zero=state(F.lit(0).cast("bigint"), none, none, none),
                step=lambda a, row: merge(a, state(F.lit(1).cast("bigint"), row[value], row[value], none)),
                merge=merge)


def running_average_fold(value: str) -> Fold:
    """The running average as a fold: the accumulator is (sum_power, num_data_points, average)."""
    def state(total: Column, n: Column) -> Column:
        mean = F.when(n > 0, total / n).otherwise(F.lit(0.0))
        return F.struct(total.alias("sum_power"), n.alias("num_data_points"),
                        mean.alias("average"))

    return Fold(
        zero=F.struct(F.lit(0.0).alias("sum_power"), F.lit(0).cast("bigint").alias("num_data_points"),
                      F.lit(0.0).alias("average")),
        step=lambda a, row: state(a["sum_power"] + row[value], a["num_data_points"] + 1),
        merge=lambda a, b: state(a["sum_power"] + b["sum_power"],
                                 a["num_data_points"] + b["num_data_points"]))
