"""Table sinks that take every micro-batch once, however often it is delivered.

A batch is written to a folder of its own, `data/batch_id=N`, replacing what an earlier attempt
left. Then one small file in `manifest/batch_id=N` commits it; readers join the manifest. All
outputs of a batch, and the input positions it reached, so become visible together or not at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.operators.aggregates import latest_by_key
from windflow.schemas import struct_of

_POSITIONS = struct_of("topic STRING, partition INT, next_offset BIGINT")
# Records that could not be read, as they came.
REJECTS = struct_of("topic STRING, partition INT, offset BIGINT, key STRING, value STRING")


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table at `path`, empty when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


class BatchLog:
    """A table of committed micro-batches at `path`, of rows of `schema`.

    `sides` names further outputs of a batch (rejects, events) with their schemas: they become visible
    with its rows, by the same commit. One `path` belongs to one checkpoint: batch ids of another
    job would be taken for repeats.

    `compact` folds batches into segments, of which there are about as many as the rows have binary
    digits: a segment is merged with the one before it once it is half as large.
    """

    _SEGMENTS = struct_of("first BIGINT, upto BIGINT, n BIGINT")

    def __init__(self, path: str, schema: T.StructType, partition_by: Sequence[str] = ("topic",),
                 sides: Mapping[str, T.StructType] | None = None):
        self.path, self.schema, self.partition_by = path.rstrip("/"), schema, tuple(partition_by)
        self.sides = dict(sides or {})

    def write(self, rows: DataFrame, batch_id: int, source: DataFrame | None = None,
              **sides: DataFrame) -> None:
        """Write and commit one batch with its side outputs, unless it is committed already.

        `source` is the micro-batch the rows come from; its next offsets are committed with them.
        """
        if set(sides) - set(self.sides):
            raise ValueError(f"the log has no output {sorted(set(sides) - set(self.sides))}")
        if self.is_committed(rows.sparkSession, batch_id):
            return
        for name, df in sides.items():
            (df.select(*self.sides[name].names).write.mode("overwrite")
             .parquet(f"{self.path}/side-{name}/batch_id={batch_id}"))
        (rows.select(*self.schema.names).write.mode("overwrite").partitionBy(*self.partition_by)
         .parquet(f"{self.path}/data/batch_id={batch_id}"))
        self.commit(rows.sparkSession, batch_id, source)

    def is_committed(self, spark: SparkSession, batch_id: int) -> bool:
        if batch_id <= self._folded(spark):
            return True
        mark = read_if_there(spark, f"{self.path}/manifest/batch_id={batch_id}", _POSITIONS)
        return not mark.isEmpty()

    def commit(self, spark: SparkSession, batch_id: int, source: DataFrame | None) -> None:
        mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in _POSITIONS.fields])
        if source is not None:
            # One row per log partition.
            mark = mark.unionByName(source.groupBy("topic", "partition").agg(
                (F.max("offset") + 1).alias("next_offset")))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch_id={batch_id}")

    _MANIFEST = T.StructType([*_POSITIONS.fields, T.StructField("batch_id", T.LongType())])

    def _segments(self, spark: SparkSession) -> list[tuple[int, int, int]]:
        """(first batch, last batch, rows) of the segments, from the newest complete list."""
        lists = read_if_there(spark, f"{self.path}/segments", T.StructType(
            [*self._SEGMENTS.fields, T.StructField("version", T.LongType())]))
        rows = lists.collect()  # two short lists at most
        newest = max((r["version"] for r in rows), default=None)
        return sorted((r["first"], r["upto"], r["n"]) for r in rows if r["version"] == newest)

    def _folded(self, spark: SparkSession) -> int:
        return max((upto for _, upto, _ in self._segments(spark)), default=-1)

    def _segment(self, first: int, upto: int) -> str:
        return f"{self.path}/folded/{first}-{upto}"

    def manifest(self, spark: SparkSession) -> DataFrame:
        """The commits: a row per batch, and one for each position it reached. Those of folded batches
        are kept as the positions that their segment reached, under its last batch."""
        segments = self._segments(spark)
        found = read_if_there(spark, f"{self.path}/manifest", self._MANIFEST).filter(
            F.col("batch_id") > max((u for _, u, _ in segments), default=-1))
        for first, upto, _ in segments:
            found = found.unionByName(read_if_there(spark, f"{self._segment(first, upto)}/manifest", self._MANIFEST))
        return found

    def stream_commits(self, spark: SparkSession) -> DataFrame:
        """`batch_id` of each commit as a stream, and of the last batch of each new list of segments: whatever a
        follower has to look at, also where it begins after a compaction."""
        for name in ("manifest", "segments"):
            make_folder(spark, f"{self.path}/{name}")
        fresh = spark.readStream.schema(self._MANIFEST).parquet(f"{self.path}/manifest")
        folded = spark.readStream.schema(self._SEGMENTS).parquet(f"{self.path}/segments")
        return fresh.select("batch_id").union(folded.select("upto"))

    def last(self, spark: SparkSession) -> int:
        """The last committed batch, -1 if there is none."""
        marks = read_if_there(spark, f"{self.path}/manifest", self._MANIFEST)
        return max(marks.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0], self._folded(spark))

    def positions(self, spark: SparkSession) -> DataFrame:
        """The committed input position per topic and partition."""
        return (self.manifest(spark).filter(F.col("topic").isNotNull())
                .groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset")))

    def read(self, spark: SparkSession, commits: DataFrame | None = None, side: str | None = None) -> DataFrame:
        """The rows of all committed batches, or of those in `commits`, with their `batch_id`; with
        `side`, those of that side output."""
        schema = self.sides[side] if side else self.schema
        with_id = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        name = f"side-{side}" if side else "data"
        segments = self._segments(spark)
        fresh = read_if_there(spark, f"{self.path}/{name}", with_id).filter(
            F.col("batch_id") > max((u for _, u, _ in segments), default=-1))
        marks = read_if_there(spark, f"{self.path}/manifest", self._MANIFEST)
        rows = fresh.join(marks.select("batch_id").distinct(), "batch_id", "left_semi").select(*with_id.names)
        for first, upto, _ in segments:
            rows = rows.unionByName(read_if_there(spark, f"{self._segment(first, upto)}/{name}", with_id))
        if commits is not None:
            rows = rows.join(commits.select("batch_id").distinct(), "batch_id", "left_semi")
        return rows

    def compact(self, spark: SparkSession, upto: int | None = None) -> None:
        """Fold the committed batches, up to `upto`, into a segment and remove their folders.

        Call it between batches. Followers go on from segments as from batches. A reader that began before
        reads again if its files are gone. If it stops half way nothing is lost: the
        folders go only after the new list of segments is complete.
        """
        segments = self._segments(spark)
        last = max((u for _, u, _ in segments), default=-1)
        marks = read_if_there(spark, f"{self.path}/manifest", self._MANIFEST).filter(F.col("batch_id") > last)
        if upto is not None:
            marks = marks.filter(F.col("batch_id") <= upto)
        ids = sorted(r["batch_id"] for r in marks.select("batch_id").distinct().collect())  # since the last call
        if not ids:
            return
        n, first, merged = self.read(spark, marks).filter(F.col("batch_id") > last).count(), ids[0], []
        while segments and segments[-1][2] <= 2 * n:
            merged.append(segments.pop())
            n, first = n + merged[-1][2], merged[-1][0]
        folder = self._segment(first, ids[-1])
        taken = (F.col("batch_id") >= first) & (F.col("batch_id") <= ids[-1])
        for side in [None, *self.sides]:
            part = self.read(spark, side=side).filter(taken)
            # Small batches become few files.
            part.repartition(max(1, -(-n // 1_000_000))).write.mode("overwrite").partitionBy(
                *(() if side else self.partition_by)).parquet(f"{folder}/{f'side-{side}' if side else 'data'}")
        (self.manifest(spark).filter(taken).groupBy("topic", "partition")
         .agg(F.max("next_offset").alias("next_offset"), F.max("batch_id").alias("batch_id"))
         .coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest"))
        rows = [*segments, (first, ids[-1], n)]
        spark.createDataFrame(rows, self._SEGMENTS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/segments/version={ids[-1]}")
        for old_first, old_upto, _ in merged:
            remove(spark, self._segment(old_first, old_upto))
        for batch_id in ids:
            for name in ("data", "manifest", *[f"side-{s}" for s in self.sides]):
                remove(spark, f"{self.path}/{name}/batch_id={batch_id}")
        if last >= 0:
            remove(spark, f"{self.path}/segments/version={last}")


class ChangelogTable:
    """A keyed table that a stream keeps up to date: the newest row per key.

    A micro-batch adds the newest row of each key it touched, deletions included, so its cost
    grows with the batch and not with the table. Reading takes the newest row over all batches
    since the last `compact`.
    """

    def __init__(self, path: str, schema: T.StructType, key: str = "key", order: str = "offset"):
        if "is_deleted" in schema.names:
            raise ValueError("is_deleted is the table's own column")
        self.path, self.key, self.order, self.schema = path.rstrip("/"), key, order, schema
        stored = T.StructType([*schema.fields, T.StructField("is_deleted", T.BooleanType())])
        self.changes = BatchLog(f"{self.path}/changes", stored, partition_by=(), sides={"rejects": REJECTS})
        self._base = T.StructType([*stored.fields, T.StructField("upto", T.LongType())])

    def upsert(self, rows: DataFrame, batch_id: int, tombstone=None, **sides: DataFrame) -> None:
        dead = F.coalesce(tombstone, F.lit(False)) if tombstone is not None else F.lit(False)
        marked = rows.select(*self.schema.names, dead.alias("is_deleted"))
        newest = latest_by_key(marked, self.key, self.order)
        self.changes.write(newest, batch_id, **sides)

    def _rows(self, spark: SparkSession) -> DataFrame:
        done = read_if_there(spark, f"{self.path}/compacted", struct_of("upto BIGINT"))
        last = done.agg(F.coalesce(F.max("upto"), F.lit(-1)).alias("upto")).scalar()
        base = read_if_there(spark, f"{self.path}/base", self._base).filter(F.col("upto") == last)
        newer = self.changes.read(spark).filter(F.col("batch_id") > last)
        return base.drop("upto").unionByName(newer.drop("batch_id"))

    def read(self, spark: SparkSession) -> DataFrame:
        return latest_by_key(self._rows(spark), self.key, self.order,
                             F.col("is_deleted")).drop("is_deleted")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold the batches up to and including `upto` into one base; call it between batches."""
        newest = self._rows(spark)
        whole = latest_by_key(newest, self.key, self.order, F.col("is_deleted"))
        whole.write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")
        before = [r["upto"] for r in read_if_there(spark, f"{self.path}/compacted", struct_of("upto BIGINT")).collect()]
        (spark.range(1).select(F.lit(upto).cast("bigint").alias("upto")).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/compacted"))
        self.changes.compact(spark, upto)
        for old in before:
            if old < upto:
                remove(spark, f"{self.path}/base/upto={old}")

