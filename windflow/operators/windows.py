"""Event-time windows: tumbling, hopping, session; final results and late records.

Tumbling and hopping windows are plain grouped aggregates, so every map task combines its own rows
before the shuffle and a hot key costs one small row per task and window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windflow.functions.durations import hours, interval, micros
from windflow.functions.power import energy_wh, wh_to_mwh
from windflow.operators.aggregates import present
from windflow.operators.blocks import BLOCK, from_earlier_blocks, so_far, with_block


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _combined(df: DataFrame, keys: list[str], window: Column, total: Column, n: Column) -> DataFrame:
    return (df.groupBy(*keys, window.alias("window"))
            .agg(total.alias("sum_power"), n.alias("num_data_points")))


def windowed_average(df: DataFrame, key: str | Sequence[str], ts: str, value: str, size: str,
                     slide: str | None = None) -> DataFrame:
    """Sum, number and average per key and window; `slide` makes the windows hop.

    Windows are aligned to the epoch and hold `[start, end)`. On a stream, set a watermark on
    `ts` first. The window comes out as the plain columns `window_start` and `window_end`.

    Rows of hopping windows are first summed up per pane, the longest stretch that all windows are made
    of, and only panes are copied into their windows. A stream can aggregate a pane only once it is
    final, so there rows are copied.
    """
    keys = _keys(key)
    rows = present(df, *keys, value)
    total, n = F.sum(value), F.count(value)
    if slide is None:
        result = _combined(rows, keys, F.window(ts, size), total, n)
    elif df.isStreaming:
        result = _combined(rows, keys, F.window(ts, size, slide), total, n)
    else:
        pane = f"{math.gcd(micros(size), micros(slide))} microseconds"
        panes = (_combined(rows, keys, F.window(ts, pane), total, n)
                 .withColumn("__at", F.col("window.start")).drop("window"))
        result = _combined(panes, keys, F.window("__at", size, slide), F.sum("sum_power"),
                           F.sum("num_data_points"))
    return result.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "sum_power", "num_data_points",
        (F.col("sum_power") / F.col("num_data_points")).alias("average"))


def with_energy(averages: DataFrame, size: str) -> DataFrame:
    """Windowed averages in watts with the energy of their windows of length `size`."""
    return (averages.withColumn("energy_wh", energy_wh(F.col("average"), hours(size)))
            .withColumn("generated_power_in_mwh", wh_to_mwh(F.col("energy_wh"))))


def energy_per_window(df: DataFrame, key: str | Sequence[str], ts: str, power_in_watts: str,
                      size: str = "1 minute") -> DataFrame:
    """Energy per key and window: the average power times the window's length."""
    return with_energy(windowed_average(df, key, ts, power_in_watts, size), size)


# Microseconds of a stretch of time in which a key's slots are put in order together.
SESSION_BLOCK = micros("1 day")


def session_slots(df: DataFrame, keys: Sequence[str], ts: str, value: str, gap: str) -> DataFrame:
    """Rows combined per epoch-aligned slot as long as the gap, whose rows always share a session:
    the keys with `first`, `last`, `sum_power` and `num_data_points`."""
    return (present(df, *keys, value, ts).groupBy(*keys, F.window(ts, gap).alias("slot"))
            .agg(F.min(ts).alias("first"), F.max(ts).alias("last"),
                 F.sum(value).alias("sum_power"), F.count(value).alias("num_data_points")).drop("slot"))


def joined_intervals(intervals: DataFrame, keys: Sequence[str], gap: str, width: int = SESSION_BLOCK) -> DataFrame:
    """Intervals, as `session_slots` gives them, that overlap or are at most a gap apart become one.

    They are put in order per keys and `width` of time. What earlier stretches hand over is the last row so
    far, and then the number of sessions.
    """
    blocked = with_block(intervals, "first", width)
    by_time = Window.partitionBy(*keys, BLOCK).orderBy("first", "last")
    last_so_far = from_earlier_blocks(blocked, keys, {"__earlier": (F.max("last"), F.max)})
    # An interval may span those that begin after it, so its neighbour's end alone does not tell.
    before = F.greatest(F.max("last").over(by_time.rowsBetween(Window.unboundedPreceding, -1)), F.col("__earlier"))
    marked = (blocked.join(last_so_far, [*keys, BLOCK])
              .withColumn("__new", F.coalesce(before + F.expr(interval(gap)) < F.col("first"), F.lit(True)).cast("int")))
    counted = from_earlier_blocks(marked, keys, {"__sessions": (F.sum("__new"), F.sum)})
    here = F.sum("__new").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = marked.withColumn("__here", here).join(counted, [*keys, BLOCK]).withColumn(
        "__session", F.col("__here") + F.coalesce("__sessions", F.lit(0)))
    return (numbered.groupBy(*keys, "__session")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("sum_power").alias("sum_power"),
                 F.sum("num_data_points").alias("num_data_points")).drop("__session"))


def as_sessions(intervals: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    return intervals.select(
        *keys, F.col("first").alias("window_start"), (F.col("last") + F.expr(interval(gap))).alias("window_end"),
        "sum_power", "num_data_points", (F.col("sum_power") / F.col("num_data_points")).alias("average"))


def session_average(df: DataFrame, key: str, ts: str, value: str, gap: str,
                    width: int = SESSION_BLOCK) -> DataFrame:
    """Sum, number and average per key and session, a session ending after `gap` of silence (batch).

    Rows exactly one gap apart share a session; `window_end` is the last row plus the gap. Rows are combined
    per slot before the shuffle. On a stream use `ExactSessions`, or `session_average_stream`.
    """
    return as_sessions(joined_intervals(session_slots(df, [key], ts, value, gap), [key], gap, width), [key], gap)


def final_sessions(df: DataFrame, key: str, ts: str, value: str, partition: str, order: str, gap: str,
                   grace: str = "0 seconds", width: int | None = None,
                   session_width: int = SESSION_BLOCK) -> DataFrame:
    """One row per session that no record can extend any more, late records left out: the exact rule (batch).

    A record is late when a session of it alone, plus `grace`, had ended by its log partition's clock as of the
    record itself. A session is final once the clock is past its end by a gap and `grace`: what comes then and
    is not late lies more than a gap behind it. So the rule does not depend on other keys' sessions.
    """
    rows = present(df, key, ts, value).select(key, ts, value, partition, order)
    clocks = rows.groupBy(partition).agg(F.max(ts).alias("__clock"))
    kept = in_time(rows, ts, partition, order, gap, grace, width)
    keys = [partition, key]
    sessions = joined_intervals(session_slots(kept, keys, ts, value, gap), keys, gap, session_width)
    return as_sessions(sessions.join(clocks, partition).filter(is_final(F.col("last"), F.col("__clock"), gap, grace)),
                       keys, gap)


def is_final(last: Column, clock: Column, gap: str, grace: str) -> Column:
    """Whether no record that is in time can join a session whose last row is at `last`."""
    return last + F.expr(interval(gap)) + F.expr(interval(gap)) + F.expr(interval(grace)) <= clock


def session_average_stream(df: DataFrame, key: str, ts: str, value: str, gap: str) -> DataFrame:
    """`session_average` on a stream that has a watermark on `ts`; sessions come out once closed."""
    return (present(df, key, value).groupBy(key, F.session_window(ts, gap).alias("window"))
            .agg(F.sum(value).alias("sum_power"), F.count(value).alias("num_data_points"))
            .select(key, F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "sum_power", "num_data_points",
                    (F.col("sum_power") / F.col("num_data_points")).alias("average")))


def with_stream_time(df: DataFrame, ts: str, partition: str, order: str,
                     width: int | None = None, name: str = "stream_time",
                     clock: str | None = None) -> DataFrame:
    """`df` with the largest event time seen in its log partition up to and including each row.

    `clock` names a further column for the largest event time of the whole log partition, which
    the per-block totals give for nothing.
    """
    blocked = with_block(df, order, width)
    before = from_earlier_blocks(blocked, [partition], {"__before": (F.max(ts), F.max)},
                                 {clock: (F.max(ts), F.max)} if clock else None)
    return (blocked.withColumn("__here", F.max(ts).over(so_far([partition], order)))
            .join(before, [partition, BLOCK])
            .withColumn(name, F.greatest("__here", "__before"))
            .drop("__here", "__before", BLOCK))


def mark_late(df: DataFrame, ts: str, partition: str, order: str, size: str,
              grace: str = "0 seconds", width: int | None = None,
              clock: str | None = None) -> DataFrame:
    """`df` with `window_start`, `window_end`, `stream_time` and `is_late` (batch).

    A record is late when its tumbling window, plus `grace`, had closed by stream time as of the
    record itself.
    """
    timed = with_stream_time(df, ts, partition, order, width, clock=clock)
    return (timed.withColumn("__w", F.window(ts, size))
            .withColumn("window_start", F.col("__w.start"))
            .withColumn("window_end", F.col("__w.end"))
            .withColumn("is_late", F.col("stream_time") >=
                        F.col("window_end") + F.expr(interval(grace)))
            .drop("__w"))


def in_time(df: DataFrame, ts: str, partition: str, order: str, within: str,
            grace: str = "0 seconds", width: int | None = None) -> DataFrame:
    """The records that a join over `within` still takes: those whose range, plus `grace`, stream time had
    not passed as of the record itself (batch). A join without grace drops the others, as windows do."""
    timed = with_stream_time(df, ts, partition, order, width)
    return timed.filter(F.col("stream_time") < F.col(ts) + F.expr(interval(within)) + F.expr(interval(grace))
                        ).drop("stream_time")


def late_dropped(df: DataFrame, ts: str, partition: str, order: str, size: str,
                 grace: str = "0 seconds", width: int | None = None) -> DataFrame:
    """The records a windowed aggregation drops for coming too late."""
    return mark_late(df, ts, partition, order, size, grace, width).filter("is_late").drop("is_late")


def final_windows(df: DataFrame, key: str, ts: str, value: str, partition: str, order: str,
                  size: str, grace: str = "0 seconds", width: int | None = None) -> DataFrame:
    """One row per window that has closed, late records left out: the exact rule (batch).

    Each log partition has its own clock, as each is processed on its own.
    """
    rows = present(df, key, ts, value).select(key, ts, value, partition, order)
    kept = mark_late(rows, ts, partition, order, size, grace, width, "__clock").filter(~F.col("is_late"))
    windows = (kept.groupBy(partition, key, "window_start", "window_end")
               .agg(F.sum(value).alias("sum_power"), F.count(value).alias("num_data_points"),
                    F.max("__clock").alias("__clock")))
    closed = F.col("window_end") + F.expr(interval(grace)) <= F.col("__clock")
    return (windows.filter(closed).drop("__clock")
            .withColumn("average", F.col("sum_power") / F.col("num_data_points")))


def final_windows_native(df: DataFrame, key: str, ts: str, value: str, size: str,
                         grace: str = "0 seconds") -> DataFrame:
    """The same on a stream with Spark's own watermark (write it in append mode).

    Faster than the exact form and never stricter: the watermark moves between micro-batches, so a
    record late by less than a batch is still counted.
    """
    return windowed_average(df.withWatermark(ts, grace), key, ts, value, size)


def open_windows(timed: DataFrame, keys: Sequence[str], ts: str, value: str, size: str, slide: str,
                 grace: str = "0 seconds") -> DataFrame:
    """Sum and number per keys and hopping window, each record in those of its windows that were open as of
    itself (`stream_time`, as `with_stream_time` gives it).

    Records are first combined per pane and earliest open window, of which a pane has at most as many as
    windows cover it, and only these sums are copied into windows.
    """
    length, step, allowed = micros(size), micros(slide), micros(grace)
    pane = math.gcd(length, step)

    def down(at: Column, by: int) -> Column:
        return at - F.pmod(at, F.lit(by))

    at = F.unix_micros(F.col(ts).cast("timestamp"))
    clock = F.unix_micros(F.col("stream_time").cast("timestamp"))
    start = down(at, pane)
    # Windows hold a pane if they begin after its start less their length, and are open if they end after the clock.
    earliest = F.greatest(down(start - length, step), down(clock - length - allowed, step)) + step
    panes = (timed.withColumn("__pane", start).withColumn("__from", earliest)
             .groupBy(*keys, "__pane", "__from")
             .agg(F.sum(value).alias("sum_power"), F.count(value).alias("num_data_points"))
             .withColumn("__upto", down(F.col("__pane"), step)).filter("__from <= __upto"))
    return (panes.withColumn("__start", F.explode(F.sequence("__from", "__upto", F.lit(step))))
            .groupBy(*keys, F.timestamp_micros("__start").alias("window_start"),
                     F.timestamp_micros(F.col("__start") + length).alias("window_end"))
            .agg(F.sum("sum_power").alias("sum_power"), F.sum("num_data_points").alias("num_data_points")))


def final_hopping_windows(df: DataFrame, key: str, ts: str, value: str, partition: str, order: str, size: str,
                          slide: str, grace: str = "0 seconds", width: int | None = None) -> DataFrame:
    """`final_windows` for windows that hop: a record counts in each of its windows that is still open (batch)."""
    rows = present(df, key, ts, value).select(key, ts, value, partition, order)
    clocks = rows.groupBy(partition).agg(F.max(ts).cast("timestamp").alias("__clock"))
    windows = open_windows(with_stream_time(rows, ts, partition, order, width), [partition, key], ts, value, size,
                           slide, grace)
    return (windows.join(clocks, partition).filter(F.col("window_end") + F.expr(interval(grace)) <= F.col("__clock"))
            .drop("__clock").withColumn("average", F.col("sum_power") / F.col("num_data_points")))
