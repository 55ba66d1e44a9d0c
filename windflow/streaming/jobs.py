"""Start, run and describe named streaming jobs."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from windflow.session import shared_folder

BatchFunction = Callable[[DataFrame, int], None]


def checkpoint_of(df: DataFrame, name: str, checkpoint: str | None) -> str:
    """The job's own checkpoint folder: given, or under the cluster's shared folder."""
    return checkpoint or f"{shared_folder(df.sparkSession)}/jobs/{name}"


def start_job(df: DataFrame, name: str, sink: str | BatchFunction, checkpoint: str | None = None,
              output_mode: str = "append", every: str | None = None,
              options: Mapping[str, str] | None = None,
              settings: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start the job `name`, which resumes at its checkpoint where it stopped.

    `sink` is a format (`console`, `memory`, `parquet`, `kafka`) or a function of one micro-batch
    and its id. The position advances only after a micro-batch is done: a function that fails is
    run again with the same rows and the same id. `every` is a processing-time trigger, the
    counterpart of a periodic commit; without it the job reads what there is and ends. `settings` hold for
    this job only: it takes a copy of the session's when it starts, and the session gets its own back.
    """
    writer = (df.writeStream.queryName(name).outputMode(output_mode)
              .option("checkpointLocation", checkpoint_of(df, name, checkpoint))
              .options(**(options or {})))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    writer = writer.foreachBatch(sink) if callable(sink) else writer.format(sink)
    conf = df.sparkSession.conf
    before = {n: conf.get(n, None) for n in settings or {}}
    try:
        for n, value in (settings or {}).items():
            conf.set(n, value)
        return writer.start()
    finally:
        for n, value in before.items():
            conf.unset(n) if value is None else conf.set(n, value)


def run_job(df: DataFrame, name: str, sink: str | BatchFunction, timeout: int | None = None,
            **options) -> StreamingQuery:
    """Run the job until it ends, or for `timeout` seconds, and close it. Its failure is raised."""
    query = start_job(df, name, sink, **options)
    try:
        query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    finally:
        query.stop()
    return query


def describe(df: DataFrame) -> str:
    """The physical plan as text, to read before running the job."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
