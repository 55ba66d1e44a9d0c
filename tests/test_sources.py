"""Topic logs, offsets, option maps and plans."""

import pytest
from pyspark.sql import functions as F

from windflow.plans.catalog import QUERIES
from windflow.session import SETTINGS, settings_for, shared_folder
from windflow.sources import broker, relational, topic_log
from windflow.streaming.jobs import describe

from helpers import rows, write_log

LOG = [("a", 0, 0, 0, "k", "x"), ("a", 0, 1, 1, "k", "y"), ("a", 1, 0, 2, "k", "z"), ("b", 0, 0, 3, None, "w")]


def test_topic_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, LOG)
    assert rows(topic_log.read_topics(spark, path, ["a"]), "value") == [("x",), ("y",), ("z",)]
    both = topic_log.read_topics(spark, path, ["a", "b"])
    assert rows(both, "topic", "value") == [("a", "x"), ("a", "y"), ("a", "z"), ("b", "w")]
    topic_log.append_topic_log(topic_log.read_topics(spark, path, ["b"]).withColumn("topic", F.lit("c")), path)
    assert rows(topic_log.read_topics(spark, path, ["c"]), "topic", "value") == [("c", "w")]


def test_only_the_topics_files_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, LOG)
    plan = describe(topic_log.read_topics(spark, path, ["a"], {0: 1}).select("value"))
    assert "PartitionFilters: [isnotnull(topic" in plan or "PartitionFilters: [(topic" in plan
    assert "GreaterThanOrEqual(offset,1)" in plan
    assert "timestamp" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("start,end,expected", [
    ("earliest", "latest", ["x", "y", "z"]), ("latest", "latest", []), ("earliest", "earliest", []),
    ({0: 1}, "latest", ["y", "z"]), ({0: "latest"}, "latest", ["z"]), ("earliest", {0: 1}, ["x", "z"]),
    ({0: "earliest", 1: 1}, {0: "earliest"}, [])])
def test_offsets(spark, tmp_path, start, end, expected):
    write_log(spark, str(tmp_path / "log"), LOG)
    out = topic_log.read_topics(spark, str(tmp_path / "log"), ["a"], start, end)
    assert [r[0] for r in rows(out, "value")] == expected


def test_end_offsets_and_bad_positions(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, path, LOG)
    assert topic_log.end_offsets(topic_log.read_topics(spark, path, ["a"])) == {"a": {0: 2, 1: 1}}
    both = topic_log.read_topics(spark, path, ["a", "b"])
    ends = topic_log.end_offsets(both)
    assert set(ends) == {"a", "b"}
    write_log(spark, path, [("a", 0, 2, 9, "k", "new a"), ("b", 0, max(ends["b"].values()), 9, "k", "new b")])
    later = topic_log.read_topics(spark, path, ["a", "b"], ends)
    assert [r[0] for r in rows(later, "value")] == ["new a", "new b"]
    with pytest.raises(ValueError):
        topic_log.stream_topics(spark, path, ["a"], "latest")
    for function in (topic_log.from_offsets, topic_log.until_offsets):
        with pytest.raises(ValueError):
            function("middle")


def test_union_topics_fills_missing_fields(spark):
    one = spark.createDataFrame([(1,)], "x INT")
    two = spark.createDataFrame([(2, "s")], "x INT, y STRING")
    assert rows(topic_log.union_topics({"a": one, "b": two}), "topic", "x", "y") == [("a", 1, None), ("b", 2, "s")]


def test_broker_options():
    assert broker.read_options("h:9092", ["a", "b"]) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "earliest"}
    options = broker.read_options("h", ["a"], {0: 5, 1: "latest", 2: "earliest"}, {0: 9}, committed_only=True,
                                  max_records=100, min_partitions=64)
    assert options["startingOffsets"] == '{"a": {"0": 5, "1": -1, "2": -2}}'
    assert options["endingOffsets"] == '{"a": {"0": 9}}'
    assert options["kafka.isolation.level"] == "read_committed"
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("100", "64")
    per_topic = broker.read_options("h", ["a", "b"], {"a": {0: 1}, "b": {0: 2}})
    assert per_topic["startingOffsets"] == '{"a": {"0": 1}, "b": {"0": 2}}'
    assert broker.write_options("h") == {"kafka.bootstrap.servers": "h"}
    assert broker.write_options("h", "t")["topic"] == "t"


def test_broker_rows(spark):
    raw = spark.createDataFrame([("t", 0, 1, None, bytearray(b"k"), bytearray("5€".encode()))],
                                "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, "
                                "key BINARY, value BINARY")
    log = broker.as_topic_log(raw)
    assert tuple(log.first())[4:] == ("k", "5€")
    assert broker.sink_columns(log.drop("timestamp")).columns == ["topic", "key", "value", "partition"]


def test_jdbc_options(spark):
    assert relational.jdbc_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000"}
    split = relational.jdbc_options("jdbc:x", "t", "id", (0, 1000), 16, properties={"user": "u"})
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"],
            split["user"]) == ("id", "0", "1000", "16", "u")
    with pytest.raises(ValueError):
        relational.jdbc_options("jdbc:x", "t", "id")
    df = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    assert rows(relational.newer_than(df, 2)) == [(3,)]


def test_parquet_tables_have_fixed_schemas(spark, tmp_path):
    spark.createDataFrame([(1, "N")], "id INT, name STRING").write.parquet(str(tmp_path / "p"))
    assert relational.read_parquet_table(spark, str(tmp_path / "p"), "wind_parks").count() == 1


def test_settings():
    big = settings_for(100 << 40, 4000)
    assert 100_000 <= int(big["spark.sql.shuffle.partitions"]) <= 110_000
    assert int(settings_for(1 << 40, 100)["spark.sql.shuffle.partitions"]) == 8192
    assert settings_for(0, 8)["spark.sql.shuffle.partitions"] == "16"
    assert SETTINGS["spark.sql.adaptive.enabled"] == "true"


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# Plans: what must hold whatever the size of the data

def plan_of(spark, sf, name):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return describe(QUERIES[name](spark, sf))
    finally:
        for k, value in kept.items():
            spark.conf.set(k, value)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_plan_needs_one_task_or_python(spark, sf, name):
    plan = plan_of(spark, sf, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # Only the client library's key hash has no counterpart among the built-in functions.
    assert name in ("default_partition", "heavy_partition_client") or ("Python" not in plan and "ArrowEval" not in plan)
    # A single-partition exchange is fine for one scalar and for the final merge of a limit only.
    allowed = {"enrich_salted", "first_n"}
    assert "SinglePartition" not in plan or name in allowed


@pytest.mark.parametrize("name", ["running_avg_changelog", "moving_average", "enrich_asof", "final_windows"])
def test_ordered_scans_partition_by_block(spark, sf, name):
    assert "__block" in plan_of(spark, sf, name)


def test_unpruned_columns_are_not_read(spark, sf):
    schema = plan_of(spark, sf, "turbine_average").split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<user_id:bigint,value:double>"
