"""Two changelog streams joined as tables: whichever side changes, the key's row is emitted anew.

A plain stream-stream join keeps every old version of a row. Here one state per key holds only the
newest row of each side, typed as the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from windflow.schemas import struct_of

_SIDES = ("left", "right")


class _NewestOfBothSides(StatefulProcessor):
    """State per key and side: the newest row (null once deleted) and its position."""

    def __init__(self, types: dict[str, T.StructType], output: list[str]):
        self.types, self.output = types, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sides = {name: handle.getValueState(name, T.StructType([
            T.StructField("row", kind), T.StructField("position", T.LongType())])) for name, kind in self.types.items()}
        self.emitted = handle.getValueState("emitted", struct_of("live BOOLEAN"))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = {}
        for name, state in self.sides.items():
            if state.exists():
                row, position = state.get()
                before[name] = (position, None if row is None else tuple(row))
        newest = dict(before)
        for change in rows:
            # Only the newest row of each side is held, however many updates a key gets.
            name = change["side"]
            if name not in newest or change["position"] >= newest[name][0]:
                row = change[name]
                newest[name] = (change["position"], None if row is None else tuple(
                    row[n] for n in self.types[name].names))
        left, right = (newest.get(name, (None, None))[1] for name in _SIDES)
        live, was_live = left is not None and right is not None, self.emitted.exists()
        if left is None and right is None:
            # Nothing is left of the key: it leaves the state.
            for state in self.sides.values():
                state.clear()
        else:
            for name, (position, row) in newest.items():
                if before.get(name) != (position, row):
                    self.sides[name].update((row, position))
        if live and not was_live:
            self.emitted.update((True,))
        if was_live and not live:
            self.emitted.clear()
        if live or was_live:
            both = [dict(zip(self.types[name].names, row)) if live else None
                    for name, row in zip(_SIDES, (left, right))]
            yield Row(**dict(zip(self.output, (key[0], *both, not live))))

    def close(self) -> None:
        pass


def join_table_streams(left: DataFrame, right: DataFrame, key: str = "key", order: str = "offset",
                       left_name: str = "turbine_status", right_name: str = "master_data",
                       left_tombstone: Column | None = None,
                       right_tombstone: Column | None = None) -> DataFrame:
    """`key`, one struct per side and `is_deleted`, to be written in update mode.

    A row is emitted for each key that changes while both sides have a row; `is_deleted` marks a
    key that lost one of its sides. Key and rows keep their types, in the state as well. A key
    that neither side has any more leaves the state: `order` must grow within a key, as offsets do, for an
    older row would then count as new. Needs the RocksDB state
    store, which `status_job` sets for its job.
    """
    types = {side: T.StructType([f for f in df.schema.fields if f.name not in (key, order)])
             for side, df in zip(_SIDES, (left, right))}

    def changes(df: DataFrame, side: str, tombstone: Column | None) -> DataFrame:
        row = F.struct(*types[side].names)
        if tombstone is not None:
            row = F.when(~F.coalesce(tombstone, F.lit(False)), row)
        return df.filter(F.col(key).isNotNull()).select(
            F.col(key).alias("key"), F.lit(side).alias("side"), F.col(order).cast("bigint").alias("position"),
            *[row.alias(name) if name == side else F.lit(None).cast(kind).alias(name) for name, kind in types.items()])

    both = changes(left, "left", left_tombstone).unionByName(changes(right, "right", right_tombstone))
    output = T.StructType([
        T.StructField(key, left.schema[key].dataType), T.StructField(left_name, types["left"]),
        T.StructField(right_name, types["right"]), T.StructField("is_deleted", T.BooleanType())])
    return both.groupBy("key").transformWithState(
        statefulProcessor=_NewestOfBothSides(types, output.names), outputStructType=output, outputMode="Update", timeMode="None")
