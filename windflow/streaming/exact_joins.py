"""Joins of two streams that give the same rows however the input is cut into micro-batches.

Spark's stream-stream join judges late rows by a watermark that moves between micro-batches. Here, as in
`windflow.streaming.late_windows`, each log partition has a clock of its own that advances record by record, and
what a join must remember is kept by these clocks. A micro-batch is an ordinary distributed job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.functions.durations import interval
from windflow.operators.blocks import BLOCK_WIDTH
from windflow.operators.joins import enrich_as_of, join_within
from windflow.operators.windows import with_stream_time
from windflow.streaming.sinks import BatchLog
from windflow.streaming.slots import CLOCKS, Slots, advanced, as_side, other_clock, reads_once

_SIDES = ("left", "right")


class _TwoSided:
    """What the joins share: the two streams as one, the state between batches, and the results."""

    def __init__(self, path: str, left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                 partition: str, order: str, logs: tuple[int, int] | None, width: int):
        self.left, self.right, self.key, self.times = left, right, key, (left_ts, right_ts)
        self.partition, self.order, self.logs, self.width = partition, order, logs, width
        self.rows = {"left": left.schema, "right": right.schema}
        self.slots = Slots(f"{path.rstrip('/')}/state")
        key_type = left.schema[key].dataType
        self.held = T.StructType([
            T.StructField("side", T.StringType()), T.StructField("row_key", key_type),
            T.StructField("at", T.TimestampType()), T.StructField("log", T.StringType()),
            T.StructField("position", T.LongType()), *[T.StructField(n, s) for n, s in self.rows.items()]])
        self.out = BatchLog(f"{path.rstrip('/')}/joined", T.StructType([
            T.StructField(key, key_type), *[T.StructField(n, s) for n, s in self.rows.items()]]), ())

    def records(self) -> DataFrame:
        """Both streams as one, for `run_job` with this object as its sink."""
        both = [as_side(df, side, self.rows, self.key, ts, self.partition, self.order)
                for df, side, ts in zip((self.left, self.right), _SIDES, self.times)]
        return both[0].unionByName(both[1])

    def _timed(self, batch: DataFrame, before: DataFrame) -> DataFrame:
        """The batch's rows with `stream_time`, their log partition's clock as of themselves."""
        return with_stream_time(batch, "at", "log", "position", self.width).join(before, "log", "left").withColumn(
            "stream_time", F.greatest("stream_time", "clock")).drop("clock")

    def results(self, spark: SparkSession) -> DataFrame:
        """The key and both rows of all pairs found so far."""
        return self.out.read(spark).drop("batch_id")


class ExactRangeJoin(_TwoSided):
    """Pairs of one key with right within `[left - before, left + after]`, without or with a grace for late rows.

    A row that comes when its own log partition's clock has passed the end of its range, plus `grace`, joins
    nothing: the same rule as `in_time` before `join_within` in batch. Rows of both sides wait for partners until
    the other side's clock rules any out, so the state holds what the time range spans. Both logs are partitioned
    alike by key, or `logs` names the number of partitions of each.
    """

    def __init__(self, path: str, left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                 before: str, after: str | None = None, grace: str = "0 seconds", partition: str = "partition",
                 order: str = "offset", logs: tuple[int, int] | None = None, width: int = BLOCK_WIDTH):
        super().__init__(path, left, right, key, left_ts, right_ts, partition, order, logs, width)
        self.before, self.after, self.grace = before, before if after is None else after, grace
        self._stored = T.StructType([*self.held.fields, T.StructField("is_new", T.BooleanType()),
                                     T.StructField("is_over", T.BooleanType())])

    def _kept(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.slots.left_by(spark, "rows", batch_id, self._stored).filter("not is_over").select(*self.held.names)

    @reads_once
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.out.is_committed(spark, batch_id):
            return
        clocks_before = self.slots.left_by(spark, "clocks", batch_id - 1, CLOCKS)
        before, after, grace = (F.expr(interval(x)) for x in (self.before, self.after, self.grace))
        reach = F.when(F.col("side") == "left", F.col("at") + after).otherwise(F.col("at") + before)
        taken = self._timed(batch, clocks_before).filter(F.col("stream_time") < reach + grace)
        clocks = advanced(self.slots, clocks_before, batch, batch_id)
        every = self._kept(spark, batch_id - 1).withColumn("is_new", F.lit(False)).unionByName(
            taken.select(*self.held.names).withColumn("is_new", F.lit(True)))
        # A row of the other side that is still to come lies after its clock less its own reach.
        over = F.col("at") + before + after + grace <= F.col("other")
        rows = self.slots.write(
            other_clock(every, clocks, self.logs, _SIDES).withColumn("is_over", F.coalesce(over, F.lit(False)))
            .select(*self._stored.names), "rows", batch_id, ("is_over",))
        left, right = (rows.filter(F.col("side") == side) for side in _SIDES)
        new = self._pairs(left.filter("is_new"), right).unionByName(
            self._pairs(left.filter("not is_new"), right.filter("is_new")))
        self.out.write(new, batch_id)

    def _pairs(self, left: DataFrame, right: DataFrame) -> DataFrame:
        found = join_within(left.select("row_key", "at", "left"), right.select("row_key", "at", "right"), "row_key",
                            "at", "at", self.before, self.after,
                            lambda a, b: F.struct(a["left"].alias("left"), b["right"].alias("right")))
        return found.select(F.col("row_key").alias(self.key), "value.left", "value.right")

    def waiting(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows that may still find a partner after batch `batch_id`."""
        return self._kept(spark, batch_id)


class AsOfJoin(_TwoSided):
    """Each left row with the right row (a version of its key's table row) as it was at the left row's time.

    Versions of one time count in the order of their log partition and position, the last one stands. A left row
    is answered once the versions' clock, less `grace`, has passed its time; it must not be later than `lateness`
    behind its own log partition's clock, or it drops. Versions in time order but for `grace` give the rows that
    `enrich_as_of` gives in batch. State: left rows that wait, and per key the versions from the newest that a
    row to come can still ask for. `tombstone` says which versions delete their key.
    """

    def __init__(self, path: str, left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                 tombstone: Column | None = None, lateness: str = "0 seconds", grace: str = "0 seconds",
                 partition: str = "partition", order: str = "offset", logs: tuple[int, int] | None = None,
                 width: int = BLOCK_WIDTH):
        if tombstone is not None:
            right = right.withColumn("is_dead", F.coalesce(tombstone, F.lit(False)))
        else:
            right = right.withColumn("is_dead", F.lit(False))
        super().__init__(path, left, right, key, left_ts, right_ts, partition, order, logs, width)
        self.lateness, self.grace = lateness, grace
        self._stored = T.StructType([*self.held.fields, T.StructField("is_over", T.BooleanType())])

    def _state(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        return self.slots.left_by(spark, name, batch_id, self._stored)

    @reads_once
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.out.is_committed(spark, batch_id):
            return
        clocks_before = self.slots.left_by(spark, "clocks", batch_id - 1, CLOCKS)
        grace, lateness = F.expr(interval(self.grace)), F.expr(interval(self.lateness))
        asked = self._timed(batch.filter("side = 'left'"), clocks_before).filter(
            F.col("stream_time") <= F.col("at") + lateness)
        clocks = advanced(self.slots, clocks_before, batch, batch_id)
        names = self.held.names
        waiting = self._state(spark, "waiting", batch_id - 1).filter("not is_over").select(*names).unionByName(
            asked.select(*names))
        due = F.col("at") + grace < F.col("other")
        waiting = self.slots.write(
            other_clock(waiting, clocks, self.logs, _SIDES).withColumn("is_over", F.coalesce(due, F.lit(False)))
            .select(*self._stored.names), "waiting", batch_id, ("is_over",))
        versions = self._state(spark, "versions", batch_id - 1).filter("not is_over").select(*names).unionByName(
            batch.filter("side = 'right'").select(*names))
        versions = self.slots.write(self._prunable(versions, clocks).select(*self._stored.names), "versions", batch_id,
                                    ("is_over",))
        self.out.write(self._answers(waiting.filter("is_over"), versions), batch_id)

    def _prunable(self, versions: DataFrame, clocks: DataFrame) -> DataFrame:
        """Versions with `is_over`: a newer one stands before anything that a row to come can ask for."""
        grace, lateness = F.expr(interval(self.grace)), F.expr(interval(self.lateness))
        own = clocks.select("log", F.col("clock").alias("mine"))
        if self.logs is not None:
            first = clocks.filter(F.col("log").startswith("right:")).agg(
                F.when(F.count("*") >= self.logs[1], F.min("clock"))).scalar()
            timed = other_clock(versions, clocks, self.logs, _SIDES).withColumn("mine", first)
        else:
            timed = other_clock(versions, clocks, None, _SIDES).join(own, "log", "left")
        bound = F.when(F.col("other").isNotNull() & F.col("mine").isNotNull(),
                       F.least(F.col("other") - lateness, F.col("mine") - grace))
        placed = F.struct("at", "log", "position")
        timed = timed.withColumn("past", F.coalesce(F.col("at") < bound, F.lit(False)))
        newest = timed.filter("past").groupBy("row_key").agg(F.max(placed).alias("newest"))
        return timed.join(newest, "row_key", "left").withColumn(
            "is_over", F.col("past") & ((placed != F.col("newest")) | F.col("right.is_dead")))

    def _answers(self, due: DataFrame, versions: DataFrame) -> DataFrame:
        found = enrich_as_of(
            due.select("row_key", "at", "left"), versions.select("row_key", "at", "log", "position", "right"), "row_key",
            "at", lambda record, version: F.struct(record["left"].alias("left"), version["right"].alias("right")),
            F.col("right.is_dead"), ties=("log", "position"))
        return found.select(F.col("row_key").alias(self.key), "value.left", "value.right")

    def unanswered(self, spark: SparkSession) -> DataFrame:
        """Rows that still wait, with the newest versions known for them: what the join would give if no
        further version came."""
        last = self.out.manifest(spark).agg(F.max("batch_id")).first()[0]
        if last is None:
            return spark.createDataFrame([], self.out.schema)
        return self._answers(self._state(spark, "waiting", last).filter("not is_over"),
                             self._state(spark, "versions", last))
