"""Topics on a broker, through Spark's Kafka connector.

The connector is a separate jar: add `org.apache.spark:spark-sql-kafka-0-10` to the session. It
is absent where this repository is tested, so only the option maps are tested. The sink writes at
least once; where two topics must change together, use `windflow.streaming.sinks`.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windflow.functions.text import utf8_text
from windflow.sources.topic_log import EARLIEST, LATEST, Offsets, per_topic

# How the connector's JSON names the two words.
_WORDS = {LATEST: -1, EARLIEST: -2}


def _position(topics: Sequence[str], offsets: Offsets) -> str:
    """The connector's form: one word for all topics, or a position for each partition of each topic."""
    found = per_topic(topics, offsets)
    words = {p for p in found.values() if isinstance(p, str)}
    if len(words) == 1 and all(isinstance(p, str) for p in found.values()):
        return words.pop()
    if words:
        raise ValueError("the connector takes one word for all topics, or a position for each of their partitions")
    return json.dumps({t: {str(p): _WORDS.get(o, o) for p, o in parts.items()} for t, parts in found.items()})


def read_options(servers: str, topics: Sequence[str], start: Offsets = EARLIEST,
                 end: Offsets | None = None, committed_only: bool = False,
                 max_records: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Options of `format("kafka")`.

    `max_records` bounds a micro-batch; `min_partitions` splits large log partitions over more
    tasks than there are partitions.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics),
               "startingOffsets": _position(topics, start)}
    if end is not None:
        options["endingOffsets"] = _position(topics, end)
    if committed_only:
        options["kafka.isolation.level"] = "read_committed"
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def write_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Without `topic`, each record goes where its `topic` column says."""
    options = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        options["topic"] = topic
    return options


def as_topic_log(raw: DataFrame) -> DataFrame:
    """The connector's binary rows in the topic-log layout."""
    return raw.select("topic", "partition", "offset", "timestamp",
                      utf8_text(F.col("key")).alias("key"), utf8_text(F.col("value")).alias("value"))


def read_topics(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    return as_topic_log(spark.read.format("kafka")
                        .options(**read_options(servers, topics, **options)).load())


def stream_topics(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    return as_topic_log(spark.readStream.format("kafka")
                        .options(**read_options(servers, topics, **options)).load())


def sink_columns(records: DataFrame) -> DataFrame:
    """Only the columns the connector's sink takes."""
    known = ("topic", "key", "value", "partition", "headers")
    return records.select(*[c for c in known if c in records.columns])


def write_topics(records: DataFrame, servers: str, topic: str | None = None) -> None:
    (sink_columns(records).write.format("kafka").options(**write_options(servers, topic)).save())
