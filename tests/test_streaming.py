"""Streaming jobs: equal to batch however the input is split, restartable, idempotent."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from windflow.functions.codecs import Codec, decoded
from windflow.operators import aggregates, joins, windows
from windflow.operators.ledger import committed_only
from windflow.schemas import LEDGER, MASTER_DATA, READING, TOPIC_LOG, TRANSFER, struct_of
from windflow.sources import topic_log
from windflow.sources.topic_log import stream_topics
from windflow.streaming import pipelines
from windflow.streaming.fold import fold_stream
from windflow.streaming.jobs import run_job, start_job
from windflow.streaming.late_windows import ExactFinalWindows
from windflow.streaming.sinks import BatchLog, ChangelogTable

from helpers import at, rows, write_log

READINGS = "wind-turbine-data"


def reading(o, seconds, turbine, power, partition=0):
    value = json.dumps({"wind_turbine_id": turbine, "wind_park_id": "P", "current_power": power})
    return READINGS, partition, o, seconds, turbine, value


def stream(spark, path, topic=READINGS, max_files=1):
    return topic_log.stream_topics(spark, path, [topic], max_files=max_files)


def newest(collected):
    """The last row of each key over the batches of an update-mode sink, in order."""
    return sorted({r[0]: tuple(r) for batch in collected for r in batch}.values())


class Collect:
    """A foreachBatch function that keeps every batch's rows."""

    def __init__(self):
        self.batches = []

    def __call__(self, batch, batch_id):
        self.batches.append(batch.collect())


@pytest.mark.parametrize("files", [1, 3])
def test_averages_equal_batch(spark, tmp_path, files):
    path = str(tmp_path / "log")
    records = [reading(i, i, f"T{i % 4}", float(i * 7 % 50)) for i in range(60)]
    for i in range(files):
        write_log(spark, path, records[i::files])
    out = Collect()
    typed = decoded(stream(spark, path), Codec(READING))
    pipelines.averages_job(typed, "wind_turbine_id", out, checkpoint=str(tmp_path / "cp"))
    batch = decoded(topic_log.read_topics(spark, path, [READINGS]), Codec(READING))
    expected = rows(aggregates.average_by_key(batch, "wind_turbine_id", "current_power"))
    assert newest(out.batches) == expected
    assert len(out.batches) == files


def test_job_resumes_from_its_checkpoint(spark, tmp_path):
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    out = Collect()
    write_log(spark, path, [reading(i, i, "T", 1.0) for i in range(5)])
    for expected in (5, 12):
        typed = decoded(stream(spark, path), Codec(READING))
        pipelines.averages_job(typed, "wind_turbine_id", out, checkpoint=checkpoint)
        assert newest(out.batches) == [("T", float(expected), expected, 1.0)]
        write_log(spark, path, [reading(i, i, "T", 1.0) for i in range(5, 12)])


def test_default_checkpoint_is_in_the_shared_folder(spark, tmp_path):
    from pathlib import Path
    path = str(tmp_path / "log")
    write_log(spark, path, [reading(0, 0, "T", 1.0)])
    run_job(stream(spark, path), "shared-job", Collect())
    assert (Path(spark.conf.get("spark.checkpoint.dir")) / "jobs" / "shared-job" / "commits").exists()


def test_periodic_trigger_and_console(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, [reading(0, 0, "T", 1.0)])
    out = Collect()
    query = start_job(stream(spark, path), "periodic", out, checkpoint=str(tmp_path / "cp"), every="100 milliseconds")
    try:
        query.processAllAvailable()
        write_log(spark, path, [reading(1, 1, "T", 2.0)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sum(len(b) for b in out.batches) == 2
    printed = run_job(stream(spark, path), "printed", "console", checkpoint=str(tmp_path / "cp2"))
    assert printed.exception() is None and printed.lastProgress["numInputRows"] == 1


def test_timeout_stops_a_running_job(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, [reading(0, 0, "T", 1.0)])
    query = run_job(stream(spark, path), "timed", Collect(), timeout=3, checkpoint=str(tmp_path / "cp"),
                    every="100 milliseconds")
    assert not query.isActive


def transfer(o, sender, receiver, amount, flagged):
    value = json.dumps({"sender_account": sender, "receiver_account": receiver, "amount": amount,
                        "is_suspicious": flagged})
    return "bank-transactions", 0, o, o, None, value


LEDGER_ROWS = [("bank-credits", "Alice", "70€", "committed"), ("bank-credits", "Eve", "5€ <-Suspicious!", "aborted"),
               ("bank-credits", "Zoe", "9€", "committed"), ("bank-debits", "Bob", "70€", "committed"),
               ("bank-debits", "Dave", "5€ <-Suspicious!", "aborted"), ("bank-debits", "Al", "9€", "committed")]


def transfers(spark, path):
    write_log(spark, path, [transfer(0, "Alice", "Bob", 70, False), transfer(1, "Eve", "Dave", 5, True)])
    write_log(spark, path, [transfer(2, "Zoe", "Al", 9, False)])
    return stream(spark, path, "bank-transactions")


def test_transfers_commit_both_lines_with_the_position(spark, tmp_path):
    out = BatchLog(str(tmp_path / "out"), LEDGER)
    pipelines.transfers_job(transfers(spark, str(tmp_path / "log")), out, checkpoint=str(tmp_path / "cp"))
    written = out.read(spark)
    assert rows(written, "topic", "key", "value", "txn_state") == sorted(LEDGER_ROWS, key=repr)
    assert rows(committed_only(written), "key") == [("Al",), ("Alice",), ("Bob",), ("Zoe",)]
    assert rows(out.positions(spark)) == [("bank-transactions", 0, 3)]


def test_failed_batch_is_replayed_without_loss_or_duplicate(spark, tmp_path):
    out = BatchLog(str(tmp_path / "out"), LEDGER)
    source = transfers(spark, str(tmp_path / "log"))
    commit, failures = out.commit, []

    def fails_once(*args):
        if not failures:
            failures.append(1)
            raise RuntimeError("lost on purpose")
        commit(*args)

    out.commit = fails_once
    with pytest.raises(Exception, match="lost on purpose"):
        pipelines.transfers_job(source, out, checkpoint=str(tmp_path / "cp"))
    assert rows(out.read(spark)) == [], "written but not committed, so not seen"
    pipelines.transfers_job(source, out, checkpoint=str(tmp_path / "cp"))
    assert rows(out.read(spark), "topic", "key", "value", "txn_state") == sorted(LEDGER_ROWS, key=repr)


def test_same_batch_twice_leaves_the_same_rows(spark, tmp_path):
    out = BatchLog(str(tmp_path / "out"), struct_of("topic STRING, key STRING"))
    df = spark.createDataFrame([("a", "x"), ("b", "y")], out.schema)
    out.write(df, 7)
    out.write(df, 7)
    assert rows(out.read(spark), "topic", "key", "batch_id") == [("a", "x", 7), ("b", "y", 7)]


def test_follower_gets_each_committed_batch_once(spark, tmp_path):
    out = BatchLog(str(tmp_path / "out"), struct_of("topic STRING, key STRING"))
    frame = lambda *keys: spark.createDataFrame([("a", k) for k in keys], out.schema)
    got = Collect()
    follow = lambda: pipelines.follow_job(spark, out, got, checkpoint=str(tmp_path / "cp"))
    out.write(frame("x", "y"), 0)
    frame("lost").write.partitionBy("topic").parquet(f"{out.path}/data/batch_id=1")
    follow()
    out.write(frame("x", "y"), 0)
    out.write(frame("z"), 1)
    follow()
    assert [sorted(r.key for r in batch) for batch in got.batches] == [["x", "y"], ["z"]]


def test_routing_job_feeds_both_topics(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, [reading(0, 0, "T", 9_999.0), reading(1, 1, "T", 10_000.0),
                            (READINGS, 0, 2, 2, "T", "{bad"), (READINGS, 0, 3, 3, "T", None)])
    out = BatchLog(str(tmp_path / "out"), TOPIC_LOG)
    pipelines.routing_job(stream(spark, path), out, checkpoint=str(tmp_path / "cp"))
    assert rows(out.read(spark), "topic", "offset") == [("little-wind", 0), ("much-wind", 1)]
    again = decoded(topic_log.union_topics({"little-wind": out.read(spark).filter("topic = 'little-wind'")}),
                    Codec(READING))
    assert rows(again, "current_power") == [(9_999.0,)]


def master(o, key, name):
    value = None if name is None else json.dumps({"id": 1, "customer_name": name, "wind_park_name": "P"})
    return "wind-turbine-masterdata", 0, o, o, key, value


def test_table_job_keeps_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, [master(0, "k1", "a"), master(1, "k2", "b"), master(2, "k1", "c")])
    write_log(spark, path, [master(3, "k2", None), master(4, "k3", "d")])
    table = ChangelogTable(str(tmp_path / "table"),
                           struct_of("key STRING, offset BIGINT, id INT, customer_name STRING, wind_park_name STRING"))
    log = stream(spark, path, "wind-turbine-masterdata")
    pipelines.table_job(log, Codec(MASTER_DATA), table, "masters", checkpoint=str(tmp_path / "cp"))
    expected = [("k1", "c"), ("k3", "d")]
    assert rows(table.read(spark), "key", "customer_name") == expected
    table.compact(spark, 1)
    assert rows(table.read(spark), "key", "customer_name") == expected
    write_log(spark, path, [master(5, "k1", None)])
    pipelines.table_job(log, Codec(MASTER_DATA), table, "masters", checkpoint=str(tmp_path / "cp"))
    assert rows(table.read(spark), "key", "customer_name") == [("k3", "d")]


def test_enrich_sees_rows_added_between_batches(spark, tmp_path):
    log, table_path = str(tmp_path / "log"), str(tmp_path / "table")
    schema = struct_of("wind_turbine_id STRING, customer_name STRING")
    spark.createDataFrame([("T1", "one")], schema).write.parquet(table_path)
    write_log(spark, log, [reading(0, 0, "T1", 1.0), reading(1, 1, "T2", 1.0)])
    write_log(spark, log, [reading(2, 2, "T2", 2.0)])
    seen = []

    def write(batch, batch_id):
        seen.append(rows(batch, "value.turbine_data.offset", "value.master_data.customer_name"))
        if batch_id == 0:
            spark.createDataFrame([("T2", "two")], schema).write.mode("append").parquet(table_path)

    pipelines.enrich_job(decoded(stream(spark, log), Codec(READING)),
                         lambda: spark.read.schema(schema).parquet(table_path),
                         "wind_turbine_id", write, checkpoint=str(tmp_path / "cp"))
    assert seen == [[(0, "one")], [(2, "two")]]


LATE = [(0, 0, 1.0), (1, 59, 3.0), (2, 60, 5.0), (3, 30, 100.0), (4, 130, 7.0)]
FINAL = [(at(0), 2, 2.0), (at(60), 1, 5.0)]


@pytest.mark.parametrize("cuts", [[5], [2, 5], [2, 3, 4, 5], [1, 2, 3, 4, 5]])
def test_exact_final_windows_however_split(spark, tmp_path, cuts):
    path = str(tmp_path / "log")
    for first, last in zip([0, *cuts], cuts):
        write_log(spark, path, [reading(o, s, "T", v) for o, s, v in LATE[first:last]])
    job = ExactFinalWindows(str(tmp_path / "state"), "wind_turbine_id", "timestamp", "current_power", "1 minute")
    run_job(decoded(stream(spark, path), Codec(READING)), "late", job, checkpoint=str(tmp_path / "cp"))
    assert rows(job.results(spark), "window_start", "num_data_points", "average") == FINAL


def test_exact_final_windows_equal_batch_on_the_test_data(spark, sf, tmp_path):
    from windflow.plans.views import Views
    late = Views(spark, sf).late_readings().select(
        F.col("partition_id").alias("partition"), F.col("offset_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"), "wind_turbine_id", "current_power")
    job = ExactFinalWindows(str(tmp_path / "state"), "wind_turbine_id", "timestamp", "current_power", "1 hour",
                            width=50)
    bounds = late.agg(F.max("offset")).first()[0] + 1
    for batch_id, start in enumerate(range(0, bounds, bounds // 3)):
        part = late.filter((F.col("offset") >= start) & (F.col("offset") < start + bounds // 3))
        job(part, batch_id)
        if batch_id == 1:
            job(part, batch_id)
    batch = windows.final_windows(late, "wind_turbine_id", "timestamp", "current_power", "partition", "offset",
                                  "1 hour")
    columns = ["wind_turbine_id", "window_start", "window_end", "sum_power", "num_data_points"]
    assert rows(job.results(spark), "log_partition", *columns) == rows(batch, "partition", *columns)


def test_native_final_windows_may_admit_late_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    for part in (LATE[:2], LATE[2:3], LATE[3:4], LATE[4:]):
        write_log(spark, path, [reading(o, s, "T", v) for o, s, v in part])
    out = Collect()
    typed = decoded(stream(spark, path), Codec(READING))
    pipelines.energy_job(typed, out, checkpoint=str(tmp_path / "cp"))
    assert all(r.energy_wh == r.average / 60 for batch in out.batches for r in batch)
    counts = {r.window_start: r.num_data_points for batch in out.batches for r in batch}
    assert counts[at(0)] == 3 and counts[at(60)] == 1 and at(120) not in counts


def test_sessions_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, [reading(0, 0, "T", 1.0), reading(1, 10, "T", 3.0), reading(2, 21, "T", 9.0)])
    write_log(spark, path, [reading(3, 500, "T", 0.0)])
    out = Collect()
    typed = decoded(stream(spark, path), Codec(READING)).withWatermark("timestamp", "0 seconds")
    run_job(windows.session_average_stream(typed, "wind_turbine_id", "timestamp", "current_power", "10 seconds"),
            "sessions", out, checkpoint=str(tmp_path / "cp"))
    found = sorted((r.window_start, r.window_end, r.average) for batch in out.batches for r in batch)
    assert found == [(at(0), at(20), 2.0), (at(21), at(31), 9.0)]


@pytest.mark.parametrize("files", [1, 3])
def test_stream_stream_join_equals_batch(spark, tmp_path, files):
    path = str(tmp_path / "log")
    left = [reading(i, i * 13 % 300, f"T{i % 3}", float(i)) for i in range(40)]
    right = [("weather-data", 0, i, i * 29 % 300, f"T{i % 3}", "{}") for i in range(40)]
    for i in range(files):
        write_log(spark, path, left[i::files] + right[i::files])

    def joined(reader):
        a = decoded(reader(READINGS), Codec(READING)).withColumn("key", F.col("wind_turbine_id"))
        b = reader("weather-data")
        if a.isStreaming:
            # The made-up times jump about, so the watermark lets everything in.
            a, b = a.withWatermark("timestamp", "10 minutes"), b.withWatermark("timestamp", "10 minutes")
        return joins.join_within(a, b, "key", "timestamp", "timestamp").select(
            "key", F.col("value.turbine_data.offset").alias("l"), F.col("value.weather_data.offset").alias("r"))

    out = Collect()
    query = run_job(joined(lambda t: stream(spark, path, t)), "weather", out, checkpoint=str(tmp_path / "cp"))
    expected = rows(joined(lambda t: topic_log.read_topics(spark, path, [t])))
    assert expected and sorted((tuple(r) for b in out.batches for r in b), key=repr) == expected
    assert query.lastProgress is not None


def test_stream_stream_join_forgets_old_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(6):
        write_log(spark, path, [reading(i, i * 100, "T", 1.0), ("weather-data", 0, i, i * 100, "T", "{}")])
    out = Collect()
    query = pipelines.weather_job(decoded(stream(spark, path), Codec(READING)), stream(spark, path, "weather-data"),
                                  "key", out, checkpoint=str(tmp_path / "cp"))
    assert sum(len(b) for b in out.batches) == 6
    held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert held < 6, "without both time bounds all twelve rows would stay"


def changes(spark, path, topic):
    log = topic_log.stream_topics(spark, path, [topic], max_files=1)
    return log.select("key", "offset", F.col("value").alias("name"))


def test_table_streams_joined(spark, tmp_path):
    left, right = str(tmp_path / "l"), str(tmp_path / "r")
    write_log(spark, left, [("s", 0, 0, 0, "k1", "on"), ("s", 0, 1, 1, "k2", "off"), ("s", 0, 2, 2, "k1", "ON")])
    write_log(spark, right, [("m", 0, 0, 0, "k1", "a")])
    dead = F.col("name").isNull()
    out = Collect()

    def run():
        out.batches.clear()
        pipelines.status_job(changes(spark, left, "s"), changes(spark, right, "m"), out, status_tombstone=dead,
                             master_tombstone=dead, checkpoint=str(tmp_path / "cp"))
        return [(r.key, r.turbine_status and r.turbine_status.name, r.master_data and r.master_data.name,
                 r.is_deleted) for b in out.batches for r in b]

    assert run() == [("k1", "ON", "a", False)]
    write_log(spark, right, [("m", 0, 1, 5, "k1", None), ("m", 0, 2, 6, "k2", "b")])
    assert sorted(run()) == [("k1", None, None, True), ("k2", "off", "b", False)]
    write_log(spark, right, [("m", 0, 0, 7, "k2", "older")])
    assert run() in ([], [("k2", "off", "b", False)]), "an older position never replaces a newer row"


def test_user_fold_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, [reading(0, 0, "T", 10.0), reading(1, 1, "T", 20.0)])
    write_log(spark, path, [reading(2, 2, "T", 60.0), reading(3, 3, "U", 1.0)])

    def add(key: str, new: pd.DataFrame, acc: tuple) -> tuple:
        total, n = acc[0] + float(new["current_power"].sum()), acc[1] + len(new)
        return total, n, total / n

    out = Collect()
    folded = fold_stream(decoded(stream(spark, path), Codec(READING)), "wind_turbine_id", lambda: (0.0, 0, 0.0),
                         add, struct_of("sum_power DOUBLE, num_data_points BIGINT, average DOUBLE"))
    run_job(folded, "fold", out, checkpoint=str(tmp_path / "cp"), output_mode="update")
    assert newest(out.batches) == [("T", 90.0, 3, 30.0), ("U", 1.0, 1, 1.0)]


def test_maintenance_log_and_events_share_a_batch(spark, tmp_path):
    from windflow.schemas import MAINTENANCE, OUTBOX_EVENT
    work = struct_of("turbine_id INT, date TIMESTAMP, actions_performed STRING, maintenance_costs DOUBLE, "
                     "remarks STRING, months_ahead INT")
    spark.createDataFrame([(1, at(0), "Oil change", 1.0, "x", 2), (2, at(1), "Blade inspection", 2.0, None, 3)],
                          work).write.parquet(str(tmp_path / "work"))
    out = BatchLog(str(tmp_path / "out"), MAINTENANCE, partition_by=(), sides={"events": OUTBOX_EVENT})
    pipelines.maintenance_job(spark.readStream.schema(work).parquet(str(tmp_path / "work")),
                              ["turbine_id", "date"], out, checkpoint=str(tmp_path / "cp"))
    assert rows(out.read(spark), "turbine_id", "batch_id") == [(1, 0), (2, 0)]
    assert rows(out.read(spark, side="events"), "aggregateid", "batch_id") == [("1", 0), ("2", 0)]


def test_a_crash_between_outputs_shows_neither(spark, tmp_path, monkeypatch):
    out = BatchLog(str(tmp_path / "out"), struct_of("x INT"), (), {"events": struct_of("y INT")})
    one, two = spark.createDataFrame([(1,)], "x INT"), spark.createDataFrame([(2,)], "y INT")
    monkeypatch.setattr(out, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        out.write(one, 0, events=two)
    assert out.read(spark).count() == 0 == out.read(spark, side="events").count()
    monkeypatch.undo()
    out.write(one, 0, events=two)
    assert out.read(spark).count() == 1 == out.read(spark, side="events").count()


def test_compaction_keeps_rows_and_positions_in_few_folders(spark, tmp_path):
    out = BatchLog(str(tmp_path / "out"), struct_of("topic STRING, x BIGINT"), ("topic",), {"events": struct_of("x BIGINT")})
    for k in range(12):
        rows_k = spark.range(k, k + 1).select(F.lit("t").alias("topic"), F.col("id").alias("x"))
        source = spark.createDataFrame([("in", 0, k)], "topic STRING, partition INT, offset BIGINT")
        out.write(rows_k, k, source, events=rows_k)
        if k % 4 == 3:
            out.compact(spark)
    assert rows(out.read(spark), "x", "batch_id") == sorted([(k, k) for k in range(12)], key=repr) == rows(
        out.read(spark, side="events"), "x", "batch_id")
    assert rows(out.positions(spark)) == [("in", 0, 12)]
    assert out.is_committed(spark, 3) and out.is_committed(spark, 11) and not out.is_committed(spark, 12)
    out.write(rows_k, 5)  # a late repeat
    assert out.read(spark).count() == 12
    folders = [p for p in (tmp_path / "out").rglob("batch_id=*")] + list((tmp_path / "out" / "folded").iterdir())
    assert len(folders) <= 4


def test_rejects_are_kept(spark, tmp_path):
    from windflow.streaming.sinks import REJECTS
    path = str(tmp_path / "log")
    good = '{"sender_account":"a","receiver_account":"b","amount":70.0,"is_suspicious":false}'
    write_log(spark, path, [("bank-transactions", 0, i, i, None, v) for i, v in enumerate(
        [good, "", "  ", good + " xx", "{bad", None, good.replace("70.0", "70.5")])])
    out = BatchLog(str(tmp_path / "out"), LEDGER, sides={"rejects": REJECTS})
    pipelines.transfers_job(stream_topics(spark, path, ["bank-transactions"]), out, checkpoint=str(tmp_path / "cp"))
    assert rows(out.read(spark), "offset", "value") == [(0, "70€"), (0, "70€")]
    assert [r[0] for r in rows(out.read(spark, side="rejects"), "offset")] == [1, 2, 3, 4, 6]


def test_transfers_schema_matches_the_ledger():
    assert set(TRANSFER.names) == {"sender_account", "receiver_account", "amount", "is_suspicious"}
    assert {"topic", "key", "value", "txn_state", "next_offset"} <= set(LEDGER.names)
