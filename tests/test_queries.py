"""Every registered query against its SQL in DuckDB, on the same tables."""

import math
from datetime import datetime, timedelta

import duckdb
import pytest

import __spark_entry__ as driver
from windflow.plans.catalog import ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def database(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    yield con
    con.close()


def plain(frame):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "isoformat"):
            return str(v)
        return v.item() if hasattr(v, "item") else v
    columns = sorted(frame.columns)
    return columns, sorted(repr([cell(v) for v in row])
                           for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, database, sf, name):
    ours = plain(driver.queries()[name](spark, sf).toPandas())
    theirs = plain(database.sql(driver.oracle_sql()[name]).df())
    assert ours == theirs
    assert ours[1], "a query without rows checks nothing"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).columns == ["customer_name", "energy_mwh", "charge"]


def test_state_processors_run_in_a_session_of_defaults(spark, database, sf):
    name, provider = "stream_status_masterdata", "spark.sql.streaming.stateStore.providerClass"
    plain_session = spark.newSession()
    plain_session.conf.set("spark.sql.session.timeZone", "UTC")
    plain_session.conf.set("spark.sql.shuffle.partitions", "4")
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain_session.conf.set(provider, default)
    ours = plain(driver.queries()[name](plain_session, sf).toPandas())
    assert ours == plain(database.sql(driver.oracle_sql()[name]).df())
    assert plain_session.conf.get(provider) == default


@pytest.mark.parametrize("name", ["stream_running_avg_changelog", "stream_session_average"])
def test_steps_of_many_files_in_no_order(spark, tmp_path, name):
    """A step that takes more files than a micro-batch once read, each with records from its beginning to its end."""
    start = datetime(2024, 1, 1)
    events = [(i, start + timedelta(minutes=i), i % 5, "view", float(i % 97), "{}") for i in range(3000)]
    frame = spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                                  "props string").repartition(20, "value")
    frame.write.parquet(f"{tmp_path}/events.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        theirs = plain(con.sql(driver.oracle_sql()[name]).df())
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        ours = plain(driver.queries()[name](spark, str(tmp_path)).toPandas())
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ours == theirs
