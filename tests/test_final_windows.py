"""Sessions, hopping windows, folds, a job's state and schema versions, batch against stream and plain versions."""

import random

import pytest
from helpers import BASE, at, rows
from pyspark.sql import functions as F

from windflow.functions.codecs import Codec
from windflow.functions.evolution import by_writer, framed_json, resolved
from windflow.operators import aggregates, windows
from windflow.schemas import check_history, promotes, struct_of
from windflow.sources import avro
from windflow.streaming.exact_sessions import ExactSessions
from windflow.streaming.fold import MergedFolds
from windflow.streaming.late_windows import ExactFinalWindows
from windflow.streaming.sinks import BatchLog

COLUMNS = "partition int, offset long, k string, ts timestamp, v double"


def records(seed, n=120):
    """Out of order by up to twenty seconds, two log partitions, nulls in key, time and value."""
    draw = random.Random(seed)
    made = []
    for offset in range(n):
        p = draw.randrange(2)
        made.append((p, offset, draw.choice([f"a{p}", f"b{p}", None]) if offset % 17 == 0 else draw.choice([f"a{p}", f"b{p}"]),
                     None if offset % 23 == 5 else at(offset * 2 - draw.randrange(20)),
                     None if offset % 19 == 3 else float(draw.randrange(9))))
    return made


def in_batches(spark, job, data, cuts):
    """The job run over the records cut at the given places; the second batch is delivered twice."""
    edges = [0, *cuts, len(data)]
    for batch_id, (a, b) in enumerate(zip(edges, edges[1:])):
        for _ in range(1 + (batch_id == 1)):
            job(spark.createDataFrame(data[a:b], COLUMNS), batch_id)


def plain_sessions(data, gap, grace):
    clocks, kept = {}, {}
    for p, _, k, ts, v in data:
        if k is None or ts is None or v is None:
            continue
        t = (ts - BASE).total_seconds()
        clocks[p] = max(clocks.get(p, t), t)
        if clocks[p] < t + gap + grace:
            kept.setdefault((p, k), []).append((t, v))
    found = []
    for (p, k), values in kept.items():
        session = []
        for t, v in [*sorted(values), (float("inf"), 0)]:
            if session and t > session[-1][0] + gap:
                if session[-1][0] + 2 * gap + grace <= clocks[p]:
                    found.append((p, k, at(session[0][0]), at(session[-1][0] + gap), sum(x for _, x in session),
                                  len(session)))
                session = []
            session.append((t, v))
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed,grace", [(1, 0), (2, 4)])
def test_final_sessions_equal_a_plain_version(spark, seed, grace):
    data = records(seed)
    ours = windows.final_sessions(spark.createDataFrame(data, COLUMNS), "k", "ts", "v", "partition", "offset",
                                  "6 seconds", f"{grace} seconds", width=16, session_width=10_000_000)
    expected = plain_sessions(data, 6, grace)
    assert len(expected) > 5
    assert rows(ours, "partition", "k", "window_start", "window_end", "sum_power", "num_data_points") == expected


@pytest.mark.parametrize("cuts", [(40, 80), (1, 2, 119)])
def test_sessions_on_a_stream_do_not_depend_on_the_split(spark, tmp_path, cuts):
    data = records(3)
    frame = spark.createDataFrame(data, COLUMNS)
    job = ExactSessions(str(tmp_path), frame, "k", "ts", "v", "6 seconds", width=16, session_width=10_000_000)
    in_batches(spark, job, data, cuts)
    ours = rows(job.results(spark).withColumn("log", F.col("log").cast("int")), "log", "k", "window_start", "window_end",
                "sum_power", "num_data_points")
    assert ours == plain_sessions(data, 6, 0)
    # What stays open spans about two gaps, not the stream.
    held = job.slots.left_by(spark, "sessions", len(cuts), job._stored).filter("not is_over")
    assert 0 < held.count() < 12


def test_a_late_row_joins_open_sessions(spark, tmp_path):
    data = [(0, 0, "a", at(0), 1.0), (0, 1, "a", at(8), 1.0), (0, 2, "a", at(4), 1.0), (0, 3, "a", at(99), 1.0)]
    job = ExactSessions(str(tmp_path), spark.createDataFrame(data, COLUMNS), "k", "ts", "v", "5 seconds")
    in_batches(spark, job, data, (1, 2, 3))
    assert rows(job.results(spark), "window_start", "window_end", "num_data_points") == [(at(0), at(13), 3)]


def test_an_interval_may_span_others(spark):
    spans = spark.createDataFrame([("a", at(0), at(50), 1.0, 1), ("a", at(5), at(6), 1.0, 1), ("a", at(40), at(41), 1.0, 1),
                                   ("a", at(70), at(70), 1.0, 1)],
                                  "k string, first timestamp, last timestamp, sum_power double, num_data_points long")
    for width in (10_000_000, windows.SESSION_BLOCK):
        joined = windows.joined_intervals(spans, ["k"], "3 seconds", width)
        assert rows(joined, "first", "last", "num_data_points") == [(at(0), at(50), 3), (at(70), at(70), 1)]


def plain_hopping(data, size, slide, grace):
    clocks, sums = {}, {}
    for p, _, k, ts, v in data:
        if k is None or ts is None or v is None:
            continue
        t = (ts - BASE).total_seconds()
        clocks[p] = max(clocks.get(p, t), t)
        start = t // slide * slide
        while start > t - size:
            if clocks[p] < start + size + grace:
                total, n = sums.get((p, k, start), (0, 0))
                sums[p, k, start] = total + v, n + 1
            start -= slide
    return sorted([(p, k, at(s), at(s + size), total, n) for (p, k, s), (total, n) in sums.items()
                   if s + size + grace <= clocks[p]], key=repr)


@pytest.mark.parametrize("size,slide,grace", [(12, 4, 0), (10, 4, 3), (6, 6, 0), (3, 5, 0)])
def test_hopping_windows_in_batch_and_on_a_stream(spark, tmp_path, size, slide, grace):
    data = records(4)
    expected = plain_hopping(data, size, slide, grace)
    assert len(expected) > 5
    names = ["k", "window_start", "window_end", "sum_power", "num_data_points"]
    final = windows.final_hopping_windows(spark.createDataFrame(data, COLUMNS), "k", "ts", "v", "partition", "offset",
                                          f"{size} seconds", f"{slide} seconds", f"{grace} seconds", width=16)
    assert rows(final, "partition", *names) == expected
    job = ExactFinalWindows(str(tmp_path), "k", "ts", "v", f"{size} seconds", f"{grace} seconds",
                            slide=f"{slide} seconds")
    in_batches(spark, job, data, (33, 34, 90))
    assert rows(job.results(spark), "log_partition", *names) == expected


@pytest.mark.parametrize("neighbours,rounds", [(1, 0), (2, 1), (2, 4), (1024, 1)])
def test_fold_merges_in_rounds(spark, neighbours, rounds):
    data = [(0, o, f"k{o % 3}", at(o), float(o * 7 % 11)) for o in range(90)]
    fold = aggregates.largest_rise_fold("v")
    folded = aggregates.custom_fold(spark.createDataFrame(data, COLUMNS), "k", fold, ["v"], width=4,
                                    neighbours=neighbours, rounds=rounds)
    expected = []
    for k in range(3):
        values = [float(o * 7 % 11) for o in range(k, 90, 3)]
        expected.append((f"k{k}", 30, values[0], values[-1], max(b - a for a, b in zip(values, values[1:]))))
    assert rows(folded.select("k", "result.*")) == expected


def test_merged_folds_continue_and_emit_touched_keys(spark, tmp_path):
    data = [(0, 0, "a", at(0), 1.0), (0, 1, "b", at(1), 5.0), (0, 2, "a", at(2), 4.0), (0, 3, None, at(3), 9.0),
            (0, 4, "a", at(4), 2.0)]
    job = MergedFolds(str(tmp_path), spark.createDataFrame(data, COLUMNS), "k", aggregates.largest_rise_fold("v"), ["v"],
                      width=2)
    in_batches(spark, job, data, (2, 3))
    assert rows(job.results(spark).select("k", "result.*")) == [("a", 3, 1.0, 2.0, 3.0), ("b", 1, 5.0, 5.0, None)]
    assert rows(job.changes.read(spark), "batch_id", "k") == [(0, "a"), (0, "b"), (1, "a"), (2, "a")]
    assert isinstance(job.changes, BatchLog)


READER = struct_of("id STRING, amount DOUBLE, site STRING")


def test_records_by_their_writers_schema(spark):
    versions = {1: struct_of("id STRING, amount INT"), 300: struct_of("site STRING, id STRING, amount BIGINT, extra INT"),
                2: READER}
    df = spark.createDataFrame([(1, "x", 7.0, "s", 1), (300, "y", 8.0, "t", 2), (2, "z", 1.5, None, 3),
                                (9, "u", 1.0, "s", 4)], "sid int, id string, amount double, site string, extra int")
    value = F.lit(None).cast("binary")
    for sid in (*versions, 9):
        value = F.when(F.col("sid") == sid, framed_json(Codec(versions.get(sid, READER)), sid)).otherwise(value)
    framed = df.select("sid", value.alias("value")).union(spark.createDataFrame([(1, None)], "sid int, value binary"))
    record = by_writer(avro.payload(F.col("value")).cast("string"), avro.schema_id(F.col("value")), versions, READER,
                       {"site": "none"})
    assert rows(framed.select("sid", record.alias("r")).select("sid", "r.*")) == [
        (1, "x", 7.0, "none"), (1, None, None, None), (2, "z", 1.5, None), (300, "y", 8.0, "t"), (9, None, None, None)]


def test_resolution_refuses_before_reading(spark):
    record = F.struct(F.lit("x").alias("id"))
    with pytest.raises(ValueError, match="amount cannot be read as int"):
        resolved(record, struct_of("amount DOUBLE"), struct_of("amount INT"))
    required = struct_of("id STRING, site STRING")
    required["site"].nullable = False
    with pytest.raises(ValueError, match="site is required"):
        resolved(record, struct_of("id STRING"), required)


def test_compatibility_over_a_history():
    first, second, third = (struct_of(f"id STRING, amount {t}") for t in ("INT", "BIGINT", "DOUBLE"))
    assert promotes(first["amount"].dataType, third["amount"].dataType)
    assert check_history([first, second], third, "BACKWARD_TRANSITIVE") == []
    assert check_history([third], second, "FORWARD") == []
    assert check_history([third, second], first, "BACKWARD") == [
        "version 2: field amount changed from bigint to int"]
    assert len(check_history([third, second], first, "BACKWARD_TRANSITIVE")) == 2
    assert check_history([first], third, "FULL") != [] and check_history([], first) == []
    with pytest.raises(ValueError, match="unknown"):
        check_history([first], second, "SIDEWAYS")


def test_state_of_a_job_as_a_table(spark, tmp_path):
    from windflow.streaming.pipelines import averages_job
    from windflow.streaming.state import operators, state_table

    schema = struct_of("wind_turbine_id STRING, current_power DOUBLE")
    checkpoint = str(tmp_path / "cp")
    for batch in ([("a", 1.0), ("b", 5.0), ("a", None)], [("a", 3.0), (None, 1.0)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        averages_job(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "wind_turbine_id", "noop",
                     checkpoint=checkpoint)
    names = ("wind_turbine_id", "sum_power", "num_data_points")
    assert rows(state_table(spark, checkpoint, names=names), *names) == [("a", 4.0, 2), ("b", 5.0, 1)]
    assert rows(state_table(spark, checkpoint, batch_id=0, names=names), *names) == [("a", 1.0, 1), ("b", 5.0, 1)]
    assert operators(spark, checkpoint).count() == 1
    with pytest.raises(ValueError, match="names for the columns"):
        state_table(spark, checkpoint, names=("k",))
