"""Registered queries that run as streaming jobs, checked by the SQL of their batch forms.

Each writes the tables it needs as a topic log in the shared folder, in steps, and runs its job
after each: the job stops and resumes at its checkpoint, and hands state and positions from one
micro-batch to the next. What the job wrote is the result.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windflow.functions.codecs import Codec, decoded
from windflow.functions.text import turbine_key
from windflow.operators.aggregates import largest_rise_fold, latest_by_key
from windflow.operators.joins import join_within
from windflow.plans.catalog import ORACLE, query
from windflow.plans.views import Views
from windflow.schemas import LEDGER, READING, TOPICS, TRANSFER, struct_of
from windflow.session import shared_folder
from windflow.sources import topic_log
from windflow.streaming.exact_joins import AsOfJoin, ExactRangeJoin
from windflow.streaming.exact_sessions import ExactSessions
from windflow.streaming.fold import MergedFolds
from windflow.streaming.jobs import run_job
from windflow.streaming.late_windows import ExactFinalWindows
from windflow.streaming.pipelines import averages_job, follow_job, status_job, transfers_job
from windflow.streaming.running import RunningAverages
from windflow.streaming.sinks import BatchLog, remove
from windflow.streaming.state import state_table

STEPS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


class _Run:
    """One run's own place in the shared folder, with its topic log. The session is left as it is; the
    log and the job's state go when the run is over, and its output stays."""

    def __init__(self, v: Views):
        self.spark = v.spark
        if v.spark.conf.get("spark.checkpoint.dir", None) or v.spark.sparkContext.master.split("[")[0] != "local":
            shared = shared_folder(v.spark)
        else:
            shared = tempfile.mkdtemp(prefix="windflow-")
        self.path = f"{shared}/queries/{uuid.uuid4().hex}"
        self.log = f"{self.path}/log"
        self.checkpoint = f"{self.path}/job"

    def append(self, topic: str, records: DataFrame, key: str | None, codec: Codec) -> None:
        """Append records that carry `partition_id`, `offset_id` and `ts` as topic-log rows."""
        text_key = F.col(key) if key else F.lit(None).cast("string")
        topic_log.append_topic_log(records.select(
            F.lit(topic).alias("topic"), F.col("partition_id").alias("partition"),
            F.col("offset_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
            text_key.alias("key"), codec.encode().alias("value")), self.log)

    def stream(self, topic: str, **options) -> DataFrame:
        """All that is new in a topic as one micro-batch: tasks write a step's files side by side, so
        between these files there is no order, and jobs want one from each micro-batch to the next."""
        return topic_log.stream_topics(self.spark, self.log, [topic], **options)

    def over(self) -> None:
        for folder in (self.log, self.checkpoint):
            remove(self.spark, folder)


def _periods(arrival: str) -> list[Column]:
    """Conditions that cut the month into three parts by time of arrival."""
    first, second = (F.expr(f"TIMESTAMP_NTZ '{s}'") for s in STEPS)
    at = F.col(arrival)
    return [at < first, (at >= first) & (at < second), at >= second]


@query("stream_turbine_average", ORACLE["turbine_average"])
def stream_turbine_average(v: Views) -> DataFrame:
    run, codec = _Run(v), Codec(READING)
    out = BatchLog(f"{run.path}/out", struct_of(
        "wind_turbine_id STRING, sum_power DOUBLE, num_data_points BIGINT, average DOUBLE"), ())
    for period in _periods("ts"):
        run.append(TOPICS["readings"], v.readings().filter(period), "wind_turbine_id", codec)
        averages_job(decoded(run.stream(TOPICS["readings"]), codec), "wind_turbine_id", out.write,
                     checkpoint=run.checkpoint)
    run.over()
    return latest_by_key(out.read(v.spark), "wind_turbine_id", "batch_id").drop("batch_id")


@query("stream_final_windows", ORACLE["final_windows"])
def stream_final_windows(v: Views) -> DataFrame:
    run, codec = _Run(v), Codec(READING)
    job = ExactFinalWindows(f"{run.path}/state", "wind_turbine_id", "timestamp", "current_power", "1 hour")
    # Steps follow arrival, not event time, which lags behind it.
    for period in _periods("arrival"):
        run.append(TOPICS["readings"], v.late_readings("arrival").filter(period), "wind_turbine_id", codec)
        run_job(decoded(run.stream(TOPICS["readings"]), codec), "final-windows", job,
                checkpoint=run.checkpoint)
    run.over()
    return job.results(v.spark).select(
        F.col("log_partition").alias("partition_id"), "wind_turbine_id",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "sum_power", "num_data_points", "average")


@query("stream_transfer_ledger", ORACLE["transfer_ledger"])
def stream_transfer_ledger(v: Views) -> DataFrame:
    run, codec = _Run(v), Codec(TRANSFER)
    out = BatchLog(f"{run.path}/out", LEDGER)
    transfers = (v.transfers().withColumn("partition_id", F.pmod("offset_id", F.lit(4)).cast("int"))
                 .withColumn("ts", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")))
    for flagged in (F.col("is_suspicious"), ~F.col("is_suspicious")):
        run.append(TOPICS["transfers"], transfers.filter(flagged), None, codec)
        transfers_job(run.stream(TOPICS["transfers"]), out, checkpoint=run.checkpoint)
    run.over()
    return out.read(v.spark).select(F.col("offset").alias("offset_id"), "topic", "key", "value",
                                    "txn_state", "next_offset")


@query("stream_readings_weather", ORACLE["readings_weather"])
def stream_readings_weather(v: Views) -> DataFrame:
    run, readings = _Run(v), Codec(READING)
    weather = Codec(struct_of("turbine_id INT, wind_speed DOUBLE"))
    out = BatchLog(f"{run.path}/out", struct_of(
        "offset_id BIGINT, wind_turbine_id STRING, current_power DOUBLE, weather_offset_id BIGINT, "
        "wind_speed DOUBLE"), ())
    tables = {TOPICS["readings"]: (v.readings(), readings),
              TOPICS["weather"]: (v.weather().withColumn(
                  "partition_id", F.pmod("turbine_id", F.lit(4))), weather)}

    def side(topic: str) -> DataFrame:
        return decoded(run.stream(topic), tables[topic][1]).withWatermark("timestamp", "20 minutes")

    for period in _periods("ts"):
        for topic, (records, codec) in tables.items():
            run.append(topic, records.filter(period), "wind_turbine_id", codec)
        pairs = join_within(side(TOPICS["readings"]), side(TOPICS["weather"]), "key", "timestamp",
                            "timestamp", "20 minutes")
        flat = pairs.select(F.col("value.turbine_data.offset").alias("offset_id"),
                            F.col("key").alias("wind_turbine_id"), "value.turbine_data.current_power",
                            F.col("value.weather_data.offset").alias("weather_offset_id"),
                            "value.weather_data.wind_speed")
        run_job(flat, "readings-weather", out.write, checkpoint=run.checkpoint)
    run.over()
    return out.read(v.spark).drop("batch_id")


@query("stream_readings_weather_late", ORACLE["readings_weather_late"])
def stream_readings_weather_late(v: Views) -> DataFrame:
    """The time-range join without grace; both logs are partitioned by turbine."""
    run, readings = _Run(v), Codec(READING)
    weather = Codec(struct_of("turbine_id INT, wind_speed DOUBLE"))
    tables = [(TOPICS["readings"], v.late_readings("arrival"), readings),
              (TOPICS["weather"], v.weather().withColumn("partition_id", F.pmod("turbine_id", F.lit(4)).cast("int"))
               .withColumn("arrival", F.col("ts")), weather)]
    for period in _periods("arrival"):
        for topic, records, codec in tables:
            run.append(topic, records.filter(period), "wind_turbine_id", codec)
        left, right = (decoded(run.stream(topic), codec) for topic, _, codec in tables)
        join = ExactRangeJoin(f"{run.path}/join", left, right, "key", "timestamp", "timestamp", "20 minutes")
        run_job(join.records(), "readings-weather-late", join, checkpoint=run.checkpoint)
    run.over()
    return join.results(v.spark).select(
        F.col("left.offset").alias("offset_id"), F.col("key").alias("wind_turbine_id"), "left.current_power",
        F.col("right.offset").alias("weather_offset_id"), "right.wind_speed")


@query("stream_enrich_asof", ORACLE["enrich_asof_ties"])
def stream_enrich_asof(v: Views) -> DataFrame:
    """Readings with their master data as it was then; several changes have one time."""
    run, readings = _Run(v), Codec(READING)
    master = Codec(struct_of("customer_name STRING, is_deleted BOOLEAN"))
    changes = v.master_changes().withColumn("partition_id", F.pmod("id", F.lit(4)).cast("int")).withColumn(
        "arrival", F.col("ts")).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    tables = [(TOPICS["readings"], v.late_readings("arrival"), readings), (TOPICS["master_data"], changes, master)]
    for period in _periods("arrival"):
        for topic, records, codec in tables:
            run.append(topic, records.filter(period), "wind_turbine_id", codec)
        left, right = (decoded(run.stream(topic), codec) for topic, _, codec in tables)
        join = AsOfJoin(f"{run.path}/join", left, right, "key", "timestamp", "timestamp", F.col("is_deleted"),
                        lateness="1 day")
        run_job(join.records(), "enrich-asof", join, checkpoint=run.checkpoint)
    run.over()
    # The last day's readings still wait for changes of that day.
    return join.results(v.spark).unionByName(join.unanswered(v.spark)).select(
        F.col("left.offset").alias("offset_id"), F.col("key").alias("wind_turbine_id"), "left.current_power",
        "right.customer_name")


@query("stream_running_avg_changelog", ORACLE["running_avg_changelog"])
def stream_running_avg_changelog(v: Views) -> DataFrame:
    run, codec = _Run(v), Codec(READING)
    for period in _periods("ts"):
        run.append(TOPICS["readings"], v.readings().filter(period), "wind_turbine_id", codec)
        rows = decoded(run.stream(TOPICS["readings"]), codec).select(
            F.col("offset").alias("offset_id"), "wind_turbine_id", "current_power")
        job = RunningAverages(f"{run.path}/averages", rows, "wind_turbine_id", "current_power", "offset_id", width=512)
        run_job(rows, "running-averages", job, checkpoint=run.checkpoint)
    run.over()
    return job.results(v.spark).drop("current_power")


@query("stream_status_masterdata", ORACLE["status_masterdata"])
def stream_status_masterdata(v: Views) -> DataFrame:
    """Two changelogs joined as tables; the table that the emitted rows leave is the result."""
    run = _Run(v)
    status = Codec(struct_of("id INT, is_online BOOLEAN, status STRING"))
    master = Codec(struct_of("id INT, customer_name STRING, is_deleted BOOLEAN"))
    number = F.pmod("id", F.lit(4)).cast("int")
    tables = [(TOPICS["status"], v.turbine_status().withColumn("partition_id", number), status),
              (TOPICS["master_data"], v.master_changes().withColumn("partition_id", number), master)]
    out = BatchLog(f"{run.path}/out", struct_of(
        "id INT, is_online BOOLEAN, status STRING, customer_name STRING, is_deleted BOOLEAN"), ())

    def write(batch: DataFrame, batch_id: int) -> None:
        out.write(batch.select("id", "turbine_status.is_online", "turbine_status.status",
                               "master_data.customer_name", "is_deleted"), batch_id)

    for period in _periods("ts"):
        for topic, records, codec in tables:
            run.append(topic, records.filter(period), "wind_turbine_id", codec)
        left, right = (decoded(run.stream(topic), codec) for topic, _, codec in tables)
        status_job(left.select("id", "offset", "timestamp", "is_online", "status"),
                   right.select("id", "offset", "timestamp", "customer_name", "is_deleted"), write, key="id",
                   master_tombstone=F.col("is_deleted"), checkpoint=run.checkpoint)
    run.over()
    newest = latest_by_key(out.read(v.spark), "id", "batch_id", F.col("is_deleted"))
    return newest.select(turbine_key(F.col("id")).alias("wind_turbine_id"), "is_online", "status", "customer_name")


@query("stream_follow_ledger", ORACLE["transfer_ledger"])
def stream_follow_ledger(v: Views) -> DataFrame:
    """Followers of the ledger: one from the start, one that begins after a compaction; what both got, once."""
    run, codec = _Run(v), Codec(TRANSFER)
    ledger = BatchLog(f"{run.path}/ledger", LEDGER)
    copies = [BatchLog(f"{run.path}/out{k}", LEDGER) for k in range(2)]
    transfers = (v.transfers().withColumn("partition_id", F.pmod("offset_id", F.lit(4)).cast("int"))
                 .withColumn("ts", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")))
    for step in range(3):
        run.append(TOPICS["transfers"], transfers.filter(F.col("offset_id") % 3 == step), None, codec)
        transfers_job(run.stream(TOPICS["transfers"]), ledger, checkpoint=run.checkpoint)
        for k, copy in enumerate(copies[:1 + (step > 0)]):
            follow_job(v.spark, ledger, copy.write, checkpoint=f"{run.checkpoint}-{k}")
        if step < 2:
            ledger.compact(v.spark)
    run.over()
    both = [c.read(v.spark).select(F.col("offset").alias("offset_id"), "topic", "key", "value", "txn_state",
                                   "next_offset") for c in copies]
    return both[0].intersectAll(both[1])


@query("stream_offset_range", """
SELECT offset_id, partition_id, wind_turbine_id, current_power FROM readings
WHERE ts >= TIMESTAMP '2024-01-11 00:00:00' AND (partition_id <> 2 OR ts >= TIMESTAMP '2024-01-21 00:00:00')""",
       "readings")
def stream_offset_range(v: Views) -> DataFrame:
    """A job that starts at the latest records of a topic, one partition of it later still, and is resumed."""
    run, codec, topic = _Run(v), Codec(READING), TOPICS["readings"]
    out = BatchLog(f"{run.path}/out", struct_of(
        "offset BIGINT, partition INT, wind_turbine_id STRING, current_power DOUBLE"), ())
    first, second, third = _periods("ts")
    run.append(topic, v.readings().filter(first), "wind_turbine_id", codec)
    early = topic_log.fixed_positions(v.spark, run.log, [topic], {topic: topic_log.LATEST})
    run.append(topic, v.readings().filter(second), "wind_turbine_id", codec)
    late = topic_log.fixed_positions(v.spark, run.log, [topic], {2: topic_log.LATEST})
    start = {topic: early[topic] | late[topic]}
    for more in (None, third):
        if more is not None:
            run.append(topic, v.readings().filter(more), "wind_turbine_id", codec)
        run_job(decoded(run.stream(topic, start=start), codec), "offset-range", out.write, checkpoint=run.checkpoint)
    run.over()
    return out.read(v.spark).select(F.col("offset").alias("offset_id"), F.col("partition").alias("partition_id"),
                                    "wind_turbine_id", "current_power")


@query("stream_custom_fold", ORACLE["custom_fold"])
def stream_custom_fold(v: Views) -> DataFrame:
    run, codec = _Run(v), Codec(READING)
    for period in _periods("ts"):
        run.append(TOPICS["readings"], v.readings().filter(period), "wind_turbine_id", codec)
        rows = decoded(run.stream(TOPICS["readings"]), codec)
        job = MergedFolds(f"{run.path}/folds", rows, "wind_turbine_id", largest_rise_fold("current_power"),
                          ["current_power"], width=512)
        run_job(rows, "merged-folds", job, checkpoint=run.checkpoint)
    run.over()
    return job.results(v.spark).select("wind_turbine_id", "result.*")


def _by_partition(results: DataFrame, log: str) -> DataFrame:
    return results.select(
        F.col(log).cast("int").alias("partition_id"), "wind_turbine_id",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "sum_power", "num_data_points", "average")


@query("stream_hopping_average", ORACLE["final_hopping"])
def stream_hopping_average(v: Views) -> DataFrame:
    run, codec = _Run(v), Codec(READING)
    job = ExactFinalWindows(f"{run.path}/state", "wind_turbine_id", "timestamp", "current_power", "1 hour",
                            slide="30 minutes")
    for period in _periods("arrival"):
        run.append(TOPICS["readings"], v.late_readings("arrival").filter(period), "wind_turbine_id", codec)
        run_job(decoded(run.stream(TOPICS["readings"]), codec), "final-hopping", job, checkpoint=run.checkpoint)
    run.over()
    return _by_partition(job.results(v.spark), "log_partition")


@query("stream_session_average", ORACLE["final_sessions"])
def stream_session_average(v: Views) -> DataFrame:
    run, codec = _Run(v), Codec(READING)
    for period in _periods("arrival"):
        run.append(TOPICS["readings"], v.late_readings("arrival").filter(period), "wind_turbine_id", codec)
        rows = decoded(run.stream(TOPICS["readings"]), codec)
        job = ExactSessions(f"{run.path}/sessions", rows, "wind_turbine_id", "timestamp", "current_power", "1 hour")
        run_job(rows, "exact-sessions", job, checkpoint=run.checkpoint)
    run.over()
    return _by_partition(job.results(v.spark), "log")


@query("stream_state_table", ORACLE["turbine_average"])
def stream_state_table(v: Views) -> DataFrame:
    """The averages that a job holds in its state, read from its checkpoint after two restarts."""
    run, codec = _Run(v), Codec(READING)
    for period in _periods("ts"):
        run.append(TOPICS["readings"], v.readings().filter(period), "wind_turbine_id", codec)
        averages_job(decoded(run.stream(TOPICS["readings"]), codec), "wind_turbine_id", "noop",
                     checkpoint=run.checkpoint)
    held = state_table(v.spark, run.checkpoint, names=("wind_turbine_id", "sum_power", "num_data_points"))
    held.drop("state_partition").withColumn("average", F.col("sum_power") / F.col("num_data_points")).write.parquet(
        f"{run.path}/held")
    run.over()
    return v.spark.read.parquet(f"{run.path}/held")
