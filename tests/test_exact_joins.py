"""Joins on streams against their batch forms, with the input cut in several ways."""

import random

import pytest
from helpers import rows, write_log
from pyspark.sql import functions as F

from windflow.operators import joins, windows
from windflow.sources import broker, topic_log
from windflow.streaming import pipelines
from windflow.streaming.exact_joins import AsOfJoin, ExactRangeJoin
from windflow.streaming.jobs import run_job
from windflow.streaming.running import RunningAverages
from windflow.streaming.sinks import BatchLog
from windflow.schemas import struct_of


def logs(seed, n=120, times=40):
    """Records of two topics with two log partitions each, times in disorder and often equal."""
    draw, out = random.Random(seed), []
    for topic in ("l", "r"):
        for p in (0, 1):
            out += [(topic, p, o, o // 3 + draw.randrange(times) - times, f"k{p}{draw.randrange(2)}", f"{topic}{p}-{o}")
                    for o in range(n // 4)]
    return out


def cut(records, pieces):
    """The records in so many pieces, each log partition in the order of its offsets."""
    out = [[] for _ in range(pieces)]
    for r in records:
        out[r[2] * pieces // (max(x[2] for x in records) + 1)].append(r)
    return out


def two(spark, path):
    return [topic_log.stream_topics(spark, path, [t], max_files=2) for t in ("l", "r")]


@pytest.mark.parametrize("pieces,logs_known", [(1, None), (3, None), (4, (2, 2))])
def test_range_join_equals_batch_however_cut(spark, tmp_path, pieces, logs_known):
    records, log = logs(1), str(tmp_path / "log")
    for piece in cut(records, pieces):
        write_log(spark, log, piece)
        left, right = two(spark, log)
        join = ExactRangeJoin(str(tmp_path / "join"), left, right, "key", "timestamp", "timestamp", "4 seconds",
                              "2 seconds", logs=logs_known, width=8)
        run_job(join.records(), "j", join, checkpoint=str(tmp_path / "cp"))
    sides = [windows.in_time(topic_log.read_topics(spark, log, [t]), "timestamp", "partition", "offset", within)
             for t, within in (("l", "2 seconds"), ("r", "4 seconds"))]
    wanted = joins.join_within(*sides, "key", "timestamp", "timestamp", "4 seconds", "2 seconds")
    assert rows(join.results(spark), "left.value", "right.value") == rows(
        wanted, "value.turbine_data.value", "value.weather_data.value") != []


def test_range_join_forgets_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    for step in range(3):
        write_log(spark, log, [(t, 0, step * 50 + k, step * 1000 + k, "k", "v") for t in ("l", "r") for k in range(50)])
        left, right = two(spark, log)
        join = ExactRangeJoin(str(tmp_path / "join"), left, right, "key", "timestamp", "timestamp", "5 seconds")
        run_job(join.records(), "j", join, checkpoint=str(tmp_path / "cp"))
        last = join.out.last(spark)
        held = join.waiting(spark, last).agg(F.min("at"), F.count("*")).first()
        assert held[1] <= 2 * 11 and held[0].second >= 0
    assert join.results(spark).count() == 3 * (50 * 11 - 30)


@pytest.mark.parametrize("pieces", [1, 3])
def test_as_of_join_equals_batch_however_cut(spark, tmp_path, pieces):
    draw, log = random.Random(2), str(tmp_path / "log")
    versions = [("r", p, o, o // 4, f"k{p}{draw.randrange(2)}", None if o % 7 == 3 else f"v{p}-{o}")
                for p in (0, 1) for o in range(40)]  # four versions at a time, in order
    asked = [("l", p, o, o // 4 - draw.randrange(3), f"k{p}{draw.randrange(2)}", f"l{p}-{o}") for p in (0, 1) for o in range(40)]
    for piece in cut(versions + asked, pieces):
        write_log(spark, log, piece)
        left, right = two(spark, log)
        join = AsOfJoin(str(tmp_path / "join"), left, right, "key", "timestamp", "timestamp", F.col("value").isNull(),
                        lateness="4 seconds", width=8)
        run_job(join.records(), "j", join, checkpoint=str(tmp_path / "cp"))
    got = rows(join.results(spark).unionByName(join.unanswered(spark)), "left.value", "right.value")
    expected = []
    for _, _, _, t, key, value in asked:
        known = [(x[3], x[1], x[2], x[5]) for x in versions if x[4] == key and x[3] <= t]
        if known and max(known, key=lambda x: x[:3])[3] is not None:
            expected.append((value, max(known, key=lambda x: x[:3])[3]))
    assert got == sorted(expected, key=repr) != []
    waiting = join._state(spark, "versions", join.out.last(spark)).filter("not is_over").count()
    # Four versions a second in each log: those of the lateness and the disorder, and the newest of each key.
    assert waiting <= 2 * 4 * (4 + 2) + 4


def test_as_of_ties_do_not_depend_on_the_layout(spark):
    table = spark.createDataFrame([("k", 5, f"v{i}", i) for i in range(6)], "key string, at long, name string, place long")
    stream = spark.createDataFrame([("k", 5), ("k", 9)], "key string, at long")
    for n in (1, 3, 6):
        laid = table.repartition(n, "name")
        got = joins.enrich_as_of(stream, laid, "key", "at", width=4)
        assert rows(got, "value.master_data.name") == [("v5",), ("v5",)]
        got = joins.enrich_as_of(stream, laid.withColumn("place", -F.col("place")), "key", "at", width=4, ties=["place"])
        assert rows(got, "value.master_data.name") == [("v0",), ("v0",)]


def test_running_averages_continue(spark, tmp_path):
    log, job = str(tmp_path / "log"), None
    values = [(k % 3, k) for k in range(30)]
    for part in (values[:13], values[13:14], values[14:]):
        write_log(spark, log, [("l", 0, o, o, f"k{key}", str(o)) for key, o in part])
        stream = topic_log.stream_topics(spark, log, ["l"]).select("key", "offset", F.col("value").cast("double").alias("x"))
        job = RunningAverages(str(tmp_path / "out"), stream, "key", "x", width=4)
        run_job(stream, "r", job, checkpoint=str(tmp_path / "cp"))
    expected, total = [], {}
    for key, o in values:
        total.setdefault(key, []).append(o)
        expected.append((f"k{key}", o, float(sum(total[key])), len(total[key])))
    assert rows(job.results(spark), "key", "offset", "sum_power", "num_data_points") == sorted(expected, key=repr)


def test_follower_begins_after_compaction_and_goes_on(spark, tmp_path):
    out, got = BatchLog(str(tmp_path / "out"), struct_of("topic STRING, x BIGINT")), []
    frame = lambda x: spark.range(x, x + 1).select(F.lit("t").alias("topic"), F.col("id").alias("x"))
    follow = lambda fail=False: pipelines.follow_job(spark, out, lambda b, i: 1 / 0 if fail else got.append(
        sorted(r["x"] for r in b.collect())), checkpoint=str(tmp_path / "cp"))
    for k in range(20):
        out.write(frame(k), k)
        if k % 4 == 3 and k < 19:
            out.compact(spark)
    assert [p.name for p in (tmp_path / "out" / "folded").rglob("topic=*")]
    with pytest.raises(Exception):
        follow(fail=True)
    out.write(frame(20), 20)
    follow()
    out.compact(spark)
    follow()
    assert sorted(x for batch in got for x in batch) == list(range(21))


def test_typed_table_join_forgets_keys_without_rows(spark, tmp_path):
    left, right, got = str(tmp_path / "l"), str(tmp_path / "r"), []

    def table(path, topic):
        return topic_log.stream_topics(spark, path, [topic]).select(
            F.col("key").cast("int").alias("id"), "offset", "timestamp", F.col("value").alias("name"))

    def run():
        dead = F.col("name").isNull()
        pipelines.status_job(table(left, "s"), table(right, "m"), lambda b, i: got.extend(b.collect()), key="id",
                             status_tombstone=dead, master_tombstone=dead, checkpoint=str(tmp_path / "cp"))
        return sum(spark.read.format("statestore").option("path", str(tmp_path / "cp")).option(
            "stateVarName", name).load().count() for name in ("left", "right"))

    write_log(spark, left, [("s", 0, 0, 0.123457, "1", "on"), ("s", 0, 1, 1, "2", "off")])
    write_log(spark, right, [("m", 0, 0, 2, "1", "a")])
    assert run() == 3
    assert [(r.id, r.turbine_status.timestamp.microsecond, r.master_data.name) for r in got] == [(1, 123457, "a")]
    write_log(spark, left, [("s", 0, 2, 3, "1", None), ("s", 0, 3, 3, "2", None)])
    write_log(spark, right, [("m", 0, 1, 4, "1", None)])
    assert run() == 0 and got[-1].is_deleted


def test_positions_in_one_form(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, [(t, p, o, o, "k", "v") for t in "ab" for p in (0, 1) for o in range(3)])
    for start in ("latest", {"a": "latest"}, {0: "latest"}, {"a": {1: "latest"}}):
        with pytest.raises(ValueError):
            topic_log.stream_topics(spark, path, ["a"], start)
    fixed = lambda start: topic_log.fixed_positions(spark, path, ["a", "b"], start)
    assert fixed({"a": "latest"}) == {"a": {0: 3, 1: 3}, "b": {}}
    assert fixed({0: "latest", "b": {1: 2}}) == {"a": {0: 3}, "b": {0: 3, 1: 2}}
    assert fixed({"a": {7: "latest"}, "b": "earliest"}) == {"a": {7: 0}, "b": {}}
    with pytest.raises(ValueError):
        fixed({"a": "newest"})
    options = lambda start: broker.read_options("h", ["a", "b"], start)["startingOffsets"]
    assert options({"a": "latest", "b": "latest"}) == "latest"
    assert options({0: 5, "b": {0: "latest"}}) == '{"a": {"0": 5}, "b": {"0": -1}}'
    for start in ({"a": "latest"}, {"a": "latest", "b": {0: 1}}):
        with pytest.raises(ValueError):
            options(start)
