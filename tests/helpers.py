"""Small tables and comparisons shared by the tests."""

from datetime import datetime, timedelta

BASE = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


def rows(df, *columns):
    """The rows as a sorted list of plain tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def write_log(spark, path, records, mode="append"):
    """Append `(topic, partition, offset, seconds, key, value)` records as one file."""
    from windflow.schemas import TOPIC_LOG
    frame = spark.createDataFrame([(t, p, o, at(s), k, v) for t, p, o, s, k, v in records], TOPIC_LOG)
    frame.coalesce(1).write.mode(mode).partitionBy("topic").parquet(path)
