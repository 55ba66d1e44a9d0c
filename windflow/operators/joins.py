"""Joins between streams and tables. All are inner equi joins.

None forces a broadcast: Spark broadcasts a side only when it is small enough by
`spark.sql.autoBroadcastJoinThreshold`, judged again at run time, and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windflow.functions.durations import interval, micros
from windflow.operators.aggregates import latest_by_key, present
from windflow.operators.blocks import BLOCK, so_far, with_block
from windflow.operators.skew import join_salted

Joiner = Callable[[Column, Column], Column]


def pair(left_name: str, right_name: str) -> Joiner:
    """The usual joiner: a record with one field per side."""
    return lambda left, right: F.struct(left.alias(left_name), right.alias(right_name))


WITH_MASTER_DATA = pair("turbine_data", "master_data")
STATUS_AND_MASTER_DATA = pair("turbine_status", "master_data")
WITH_WEATHER = pair("turbine_data", "weather_data")


def _sides(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return (left.select(key, F.struct(*left.columns).alias("__left")),
            right.select(key, F.struct(*[c for c in right.columns if c != key]).alias("__right")))


def join_stream_table(stream: DataFrame, table: DataFrame, key: str,
                      joiner: Joiner = WITH_MASTER_DATA, hot_share: float | None = None,
                      spread: str | None = None) -> DataFrame:
    """Each record of `stream` with the table row of its key: `key` and the joined `value`.

    `table` has one row per key (`latest_by_key`). Only the stream side triggers output. With
    `hot_share`, the stream's keys above that share of rows are salted by `spread` (batch).
    """
    left, right = _sides(present(stream, key), table, key)
    if hot_share is not None:
        if spread is None:
            raise ValueError("salting needs the name of a column to spread by")
        joined = join_salted(left.withColumn("__spread", F.col(f"__left.{spread}")), right, key,
                             "__spread", share=hot_share)
    else:
        joined = left.join(right, key)
    return joined.select(key, joiner(F.col("__left"), F.col("__right")).alias("value"))


def enrich_as_of(stream: DataFrame, table: DataFrame, key: str, order: str,
                 joiner: Joiner = WITH_MASTER_DATA, tombstone: Column | None = None,
                 width: int | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Each record with the table row of its key as it was when the record came (batch).

    Both sides share the arrival `order`: offsets, or times where they come from logs of their own. A
    table row counts from its own position on. `ties` are columns of the table that put rows of one key and
    position in order, such as log partition and offset: the last one counts. What they leave even is
    decided by the rows themselves, so the result never depends on the layout. `tombstone` says which
    table rows delete their key. Records without a match drop.
    """
    dead = F.coalesce(tombstone, F.lit(False)) if tombstone is not None else F.lit(False)
    fields = [c for c in table.columns if c not in (key, order)]
    versions = present(table, key).select(
        key, order, F.lit(0).alias("__side"),
        F.struct(*[F.col(t).alias(f"tie{k}") for k, t in enumerate(ties)], dead.alias("dead"),
                 F.struct(*fields).alias("row")).alias("__version"))
    records = present(stream, key).select(
        key, order, F.lit(1).alias("__side"), F.struct(*stream.columns).alias("__record"))
    both = with_block(versions.unionByName(records, allowMissingColumns=True), order, width)
    before = _handed_over(both, versions, key, order, width)
    here = F.last("__version", ignorenulls=True).over(so_far([key], order, ["__side", "__version"]))
    return (both.withColumn("__here", here)
            .filter(F.col("__side") == 1)
            .join(before, [key, BLOCK])
            .withColumn("__found", F.coalesce("__here", "__before"))
            .filter(F.col("__found").isNotNull() & ~F.col("__found.dead"))
            .select(key, joiner(F.col("__record"), F.col("__found.row")).alias("value")))


def _handed_over(both: DataFrame, versions: DataFrame, key: str, order: str, width: int | None) -> DataFrame:
    """Per key and block, the newest version of the earlier blocks. Only versions are carried."""
    newest = with_block(versions, order, width).groupBy(key, BLOCK).agg(
        F.max(F.struct(order, "__version"))["__version"].alias("__newest"))
    blocks = both.select(key, BLOCK).distinct().join(newest, [key, BLOCK], "left")
    earlier = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(key, BLOCK, F.last("__newest", ignorenulls=True).over(earlier).alias("__before"))


def join_tables(left: DataFrame, right: DataFrame, key: str, order: str = "offset",
                joiner: Joiner = STATUS_AND_MASTER_DATA, left_tombstone: Column | None = None,
                right_tombstone: Column | None = None) -> DataFrame:
    """Two changelogs joined as tables: the newest row per key on each side (batch).

    On streams use `windflow.streaming.table_join`.
    """
    a, b = _sides(latest_by_key(left, key, order, left_tombstone),
                  latest_by_key(right, key, order, right_tombstone), key)
    return a.join(b, key).select(key, joiner(F.col("__left"), F.col("__right")).alias("value"))


def join_within(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                before: str = "20 seconds", after: str | None = None,
                joiner: Joiner = WITH_WEATHER) -> DataFrame:
    """Pairs of one key whose times are close: right within `[left - before, left + after]`.

    Both bounds are inclusive; `after` is `before` unless given. Joined on key and time bucket: a
    bucket is as long as the range, so a right row is in at most two, and a hot key is spread over
    its buckets instead of meeting in one task. On streams give both sides a watermark first; the
    time range then also bounds the state.
    """
    after = before if after is None else after
    span = f"{micros(before) + micros(after)} microseconds"
    if micros(before) + micros(after) <= 0:
        span = "1 microseconds"

    def bucket(df: DataFrame, name: str, at: Column) -> DataFrame:
        # window() is Spark's own alignment, the same for both kinds of timestamp.
        return (df.withColumn("__at", at).withColumn("__w", F.window("__at", span))
                .withColumn(name, F.col("__w.start")).drop("__w", "__at"))

    l_row = present(left, key, left_ts).select(
        F.col(key).alias("__key"), F.col(left_ts).alias("__left_ts"),
        F.struct(*left.columns).alias("__left"))
    r_row = present(right, key, right_ts).select(
        F.col(key).alias("__right_key"), F.col(right_ts).alias("__right_ts"),
        F.struct(*[c for c in right.columns if c != key]).alias("__right"))
    l_row = bucket(l_row, "__bucket", F.col("__left_ts"))
    r_row = bucket(r_row, "__first", F.col("__right_ts") - F.expr(interval(after)))
    r_row = bucket(r_row, "__last", F.col("__right_ts") + F.expr(interval(before)))
    r_row = (r_row.withColumn("__right_bucket",
                              F.explode(F.array_distinct(F.array("__first", "__last"))))
             .drop("__first", "__last"))
    near = ((F.col("__key") == F.col("__right_key"))
            & (F.col("__bucket") == F.col("__right_bucket"))
            & (F.col("__right_ts") >= F.col("__left_ts") - F.expr(interval(before)))
            & (F.col("__right_ts") <= F.col("__left_ts") + F.expr(interval(after))))
    return l_row.join(r_row, near).select(
        F.col("__key").alias(key), joiner(F.col("__left"), F.col("__right")).alias("value"))


def join_master_data(turbines: DataFrame, customers: DataFrame, parks: DataFrame) -> DataFrame:
    """Turbines with the names of their customer and park: the master-data record plus the price.

    The foreign keys are text; those that are no number match nothing, as do unknown ones.
    """
    t = turbines.select(F.col("id").cast("int").alias("id"),
                        F.col("customer_id").try_cast("int").alias("__customer"),
                        F.col("wind_park_id").try_cast("int").alias("__park"))
    c = customers.select(F.col("id").cast("int").alias("__customer"),
                         F.col("name").alias("customer_name"), "price_per_mwh")
    p = parks.select(F.col("id").cast("int").alias("__park"),
                     F.col("name").alias("wind_park_name"))
    return (t.join(c, "__customer").join(p, "__park")
            .select("id", "customer_name", "wind_park_name", "price_per_mwh"))
