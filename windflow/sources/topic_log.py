"""Topics as tables: `topic, partition, offset, timestamp, key, value`, in files or from a broker.

On disk a topic log is parquet partitioned by `topic`, so a reader of some topics opens only their
files, and offset bounds reach the parquet scan as pushed filters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windflow.schemas import TOPIC_LOG

EARLIEST, LATEST = "earliest", "latest"
Position = int | str
# One word for all, a position per partition, or per topic and partition.
Offsets = str | Mapping[int, Position] | Mapping[str, "str | Mapping[int, Position]"]


def per_topic(topics: Sequence[str], positions: Offsets) -> dict[str, str | dict[int, Position]]:
    """Positions in one form: for each topic a word, or its partitions' positions.

    What is said for partitions of all topics holds beside what a topic says of its own; a topic's own word
    stands for all its partitions that have no position otherwise.
    """
    if isinstance(positions, str):
        return {t: _known(positions) for t in topics}
    common = {int(p): _known(at) for p, at in positions.items() if not isinstance(p, str)}
    out: dict[str, str | dict[int, Position]] = {}
    for topic in topics:
        own = positions.get(topic, {})
        if isinstance(own, str):
            if common and own != EARLIEST:
                raise ValueError(f"{topic}: {own!r} beside positions of partitions")
            out[topic] = common or _known(own)
        else:
            out[topic] = common | {int(p): _known(at) for p, at in own.items()} or EARLIEST
    return out


def _known(position: Position) -> Position:
    if isinstance(position, str) and position not in (EARLIEST, LATEST):
        raise ValueError(f"unknown position {position!r}")
    return position


def _bounded(positions: Offsets, free: str, closed: str, compare: Callable[[Column, int], Column],
             partition: str, offset: str, topic: str) -> Column:
    """Whether a record is on the right side of its position. `free` is no bound, `closed` lets
    nothing through; topics and partitions that are not named have no bound."""
    if isinstance(positions, str):
        return F.lit(_known(positions) == free)
    keep = F.lit(True)
    for name, position in positions.items():
        if isinstance(name, str):
            inside = _bounded(position, free, closed, compare, partition, offset, topic)
            keep = keep & ((F.col(topic) != F.lit(name)) | inside)
        elif _known(position) != free:
            reached = F.lit(False) if position == closed else compare(F.col(offset), int(position))
            keep = keep & ((F.col(partition) != F.lit(int(name))) | reached)
    return keep


def from_offsets(start: Offsets, partition: str = "partition", offset: str = "offset",
                 topic: str = "topic") -> Column:
    """Whether a record lies at or after the start position.

    `start` is `earliest`, `latest`, a position per partition (a number or one of the two words), or
    such positions per topic. What it does not name is read from the earliest. `latest` starts after
    all records that exist, so a batch read of it is empty.
    """
    return _bounded(start, EARLIEST, LATEST, lambda at, n: at >= F.lit(n), partition, offset, topic)


def until_offsets(end: Offsets, partition: str = "partition", offset: str = "offset",
                  topic: str = "topic") -> Column:
    """Whether a record lies before the end position; `latest` is no bound, `earliest` is nothing."""
    return _bounded(end, LATEST, EARLIEST, lambda at, n: at < F.lit(n), partition, offset, topic)


def offset_range(df: DataFrame, start: Offsets = EARLIEST, end: Offsets = LATEST,
                 partition: str = "partition", offset: str = "offset", topic: str = "topic") -> DataFrame:
    """The records in `[start, end)`."""
    return df.filter(from_offsets(start, partition, offset, topic) & until_offsets(end, partition, offset, topic))


def read_topics(spark: SparkSession, path: str, topics: Sequence[str], start: Offsets = EARLIEST,
                end: Offsets = LATEST) -> DataFrame:
    """Some topics of a topic log, each record with its topic's name (batch)."""
    log = spark.read.schema(TOPIC_LOG).parquet(path)
    return offset_range(log.filter(F.col("topic").isin(*topics)), start, end)


def end_offsets(log: DataFrame) -> dict[str, dict[int, int]]:
    """The next offset of every partition of every topic: a start position that skips all that exists now.

    One number per log partition comes to the driver, however long the log is.
    """
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))
    found: dict[str, dict[int, int]] = {}
    for row in ends.toLocalIterator():
        found.setdefault(row["topic"], {})[row["partition"]] = row["end"]
    return found


def fixed_positions(spark: SparkSession, path: str, topics: Sequence[str], start: Offsets) -> dict[str, dict[int, int]]:
    """`start` with the words replaced by what they mean now: a position that stays when a job restarts.

    A partition without a position is read from its first record on, as are partitions that come into being later.
    """
    wanted, ends = per_topic(topics, start), end_offsets(read_topics(spark, path, topics))
    out: dict[str, dict[int, int]] = {}
    for topic, position in wanted.items():
        end = ends.get(topic, {})
        by_partition = dict.fromkeys(end, position) if isinstance(position, str) else position
        out[topic] = {p: end.get(p, 0) if at == LATEST else int(at) for p, at in by_partition.items() if at != EARLIEST}
    return out


def stream_topics(spark: SparkSession, path: str, topics: Sequence[str],
                  start: Offsets = EARLIEST, max_files: int | None = None) -> DataFrame:
    """The same as a stream. `max_files` bounds what one micro-batch reads.

    `latest`, anywhere in `start`, is refused: the word would mean another place each time the job restarts.
    Fix it once with `fixed_positions`, and nothing that is written in between is skipped.
    """
    found = per_topic(topics, start)
    if any(p == LATEST or not isinstance(p, str) and LATEST in p.values() for p in found.values()):
        raise ValueError("pass fixed_positions(...) to start a file stream at the latest record")
    reader = spark.readStream.schema(TOPIC_LOG)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    log = reader.parquet(path).filter(F.col("topic").isin(*topics))
    return log.filter(from_offsets(start))


def union_topics(topics: Mapping[str, DataFrame]) -> DataFrame:
    """Several topics consumed as one, every record tagged with its topic's name."""
    tagged = [df.withColumn("topic", F.lit(name)) for name, df in topics.items()]
    first, *rest = tagged
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def append_topic_log(records: DataFrame, path: str) -> None:
    """Append records with all columns of the topic log (batch)."""
    (records.select(*TOPIC_LOG.names).write.mode("append").partitionBy("topic").parquet(path))
