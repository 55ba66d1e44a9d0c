"""Operators on hand-worked cases, and block scans against the plain window they replace."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from windflow import schemas
from windflow.operators import aggregates, blocks, joins, ledger, outbox, routing, skew, windows
from windflow.plans.billing import customer_charge
from windflow.sources import changes, metrics

from helpers import at, rows


def readings(spark, data):
    """(offset, turbine, power) rows."""
    return spark.createDataFrame(data, "offset BIGINT, wind_turbine_id STRING, current_power DOUBLE")


# Filters, routing, limits

def test_filters_are_strict_and_routing_is_total(spark):
    df = readings(spark, [(0, "T", 9_999.0), (1, "T", 10_000.0), (2, "T", 10_001.0)])
    assert rows(routing.little_wind(df), "current_power") == [(9_999.0,)]
    assert rows(routing.much_wind(df), "current_power") == [(10_001.0,)]
    assert rows(routing.route_wind(df), "current_power", "topic") == [
        (10_000.0, "much-wind"), (10_001.0, "much-wind"), (9_999.0, "little-wind")]


def test_route_without_default_drops(spark):
    df = readings(spark, [(0, "T", 1.0), (1, "T", 2.0), (2, "T", 3.0)])
    p = F.col("current_power")
    routed = routing.route(df, [("a", p < 2), ("b", p < 3)])
    assert rows(routed, "current_power", "topic") == [(1.0, "a"), (2.0, "b")]
    with pytest.raises(ValueError):
        routing.route(df, [])


def test_map_filter_key_flat_map(spark):
    df = readings(spark, [(0, "T", 2.0), (1, "T", 3.0)])
    mapped = routing.map_values(df, lambda p: p * 10, "current_power")
    kept = routing.filter_records(mapped, lambda p: p > 20, "current_power")
    assert rows(routing.select_key(kept, F.lit("k")), "key", "current_power") == [("k", 30.0)]
    two = routing.flat_map(df, [F.struct(F.lit("x").alias("n")), F.struct(F.lit("y").alias("n"))])
    assert rows(two, "offset", "record.n") == [(0, "x"), (0, "y"), (1, "x"), (1, "y")]


def test_place_puts_records_into_their_partition(spark):
    df = readings(spark, [(i, f"T{i}", 1.0) for i in range(40)])
    tagged = routing.partition_by(df, lambda k: F.pmod(F.length(k), F.lit(4)), "wind_turbine_id")
    placed = routing.place(tagged, 4).withColumn("at", F.spark_partition_id())
    assert placed.filter("at <> partition").count() == 0


def test_heavy_producers_by_key(spark):
    df = spark.createDataFrame([("HeavyProducer_1",), ("Turbine1",), (None,)], "key STRING")
    out = {r.key: r.partition for r in routing.partition_heavy(df, 12).collect()}
    assert out["HeavyProducer_1"] < 4 <= out["Turbine1"] and out[None] is None
    assert routing.unkeyed(df).count() == 1
    with pytest.raises(ValueError):
        routing.partition_heavy(df, 4)
    with pytest.raises(ValueError):
        routing.partition_heavy(df.select(F.lit(1).alias("key")), 12)


def test_require_fails_the_job(spark):
    df = readings(spark, [(0, "T", 2.0)])
    assert routing.require(df, F.col("current_power") > 1, "low").count() == 1
    with pytest.raises(Exception, match="low power"):
        routing.require(df, F.col("current_power") > 5, "low power").collect()


def test_first_n(spark):
    df = readings(spark, [(i, "T", float(i)) for i in (5, 3, 9, 1)])
    assert rows(routing.first_n(df, 2), "offset") == [(1,), (3,)]


# Aggregates

def test_running_average_by_hand(spark):
    df = readings(spark, [(0, "T", 10.0), (1, "T", 20.0), (2, "T", 60.0)])
    out = aggregates.running_average(df, "wind_turbine_id", "current_power")
    assert rows(out, "sum_power", "num_data_points", "average") == [
        (10.0, 1, 10.0), (30.0, 2, 15.0), (90.0, 3, 30.0)]


def skewed(spark, n=600):
    """A third of all rows on one key, some keys and values null, offsets with holes."""
    return spark.range(n).select(
        (F.col("id") * 3).alias("offset"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("wind_turbine_id"),
        F.when(F.col("id") % 31 != 5, (F.col("id") * 37 % 101).cast("double")).alias("current_power"))


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 20])
def test_running_average_equals_one_window(spark, width):
    df = skewed(spark)
    ours = aggregates.running_average(df, "wind_turbine_id", "current_power", width=width)
    w = Window.partitionBy("wind_turbine_id").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.dropna().select("offset", F.sum("current_power").over(w), F.count("*").over(w))
    assert rows(ours, "offset", "sum_power", "num_data_points") == rows(plain)


@pytest.mark.parametrize("width,n", [(1, 5), (7, 5), (4, 9), (1 << 20, 3), (7, 1)])
def test_moving_average_equals_one_window(spark, width, n):
    df = skewed(spark)
    ours = aggregates.moving_average(df, "wind_turbine_id", "current_power", n, width=width)
    w = Window.partitionBy("wind_turbine_id").orderBy("offset").rowsBetween(1 - n, 0)
    plain = df.dropna().select("offset", F.avg("current_power").over(w))
    assert rows(ours, "offset", "moving_average") == rows(plain)


@pytest.mark.parametrize("width", [1, 7, 50, 1 << 20])
def test_custom_fold_keeps_order(spark, width):
    """The last rise between neighbours depends on the order of all rows."""
    def state(first, last, rise):
        return F.struct(first.alias("first"), last.alias("last"), rise.alias("rise"))

    nothing = F.lit(None).cast("double")

    def merge(a, b):
        across = b["first"] - a["last"]
        rise = F.greatest(a["rise"], b["rise"], across)
        return state(F.coalesce(a["first"], b["first"]), F.coalesce(b["last"], a["last"]), rise)

    fold = aggregates.Fold(state(nothing, nothing, nothing),
                           lambda a, r: merge(a, state(r["current_power"], r["current_power"], nothing)), merge)
    df = skewed(spark).dropna()
    ours = aggregates.custom_fold(df, "wind_turbine_id", fold, ["current_power"], width=width)
    w = Window.partitionBy("wind_turbine_id").orderBy("offset")
    rise = F.col("current_power") - F.lag("current_power").over(w)
    plain = (df.withColumn("rise", rise).groupBy("wind_turbine_id")
             .agg(F.min_by("current_power", "offset"), F.max_by("current_power", "offset"), F.max("rise")))
    assert rows(ours, "wind_turbine_id", "result.first", "result.last", "result.rise") == rows(plain)


def test_counts_and_averages_ignore_nulls(spark):
    df = readings(spark, [(0, "A", 1.0), (1, "A", None), (2, None, 5.0), (3, "B", 3.0)])
    assert rows(aggregates.count_by_key(df, "wind_turbine_id", "current_power")) == [("A", 1), ("B", 1)]
    assert rows(aggregates.count_by_key(df, "wind_turbine_id")) == [("A", 2), ("B", 1)]
    assert rows(aggregates.average_by_key(df, "wind_turbine_id", "current_power")) == [
        ("A", 1.0, 1, 1.0), ("B", 3.0, 1, 3.0)]


def test_latest_by_key_with_tombstones(spark):
    df = spark.createDataFrame([(0, "k1", "a"), (1, "k2", "b"), (2, "k1", "c"), (3, "k2", None)],
                               "offset BIGINT, key STRING, value STRING")
    out = aggregates.latest_by_key(df, "key", tombstone=F.col("value").isNull())
    assert rows(out, "key", "value") == [("k1", "c")]
    assert rows(aggregates.latest_by_key(df, "key"), "key", "value") == [("k1", "c"), ("k2", None)]


def test_row_index(spark):
    df = skewed(spark).dropna()
    ours = blocks.row_index(df, ["wind_turbine_id"], "offset", width=10)
    w = Window.partitionBy("wind_turbine_id").orderBy("offset")
    assert rows(ours, "offset", "__index") == rows(df.select("offset", F.row_number().over(w) - 1))


# Windows

def timed(spark, data):
    """(offset, seconds, value[, key[, partition]]) rows."""
    full = [(o, at(s), v, *rest, *(("T", 0)[len(rest):])) for o, s, v, *rest in data]
    return spark.createDataFrame(full, "offset BIGINT, ts TIMESTAMP, v DOUBLE, k STRING, p INT")


def test_energy_by_hand(spark):
    df = timed(spark, [(0, 1, 1200.0), (1, 59, 2400.0)])
    out = windows.energy_per_window(df, "k", "ts", "v").first()
    assert (out.average, out.energy_wh, out.window_end) == (1800.0, 30.0, at(60))
    assert out.generated_power_in_mwh == pytest.approx(3e-5)


def test_hopping_windows_overlap(spark):
    df = timed(spark, [(0, 45, 2.0)])
    out = windows.windowed_average(df, "k", "ts", "v", "1 minute", "30 seconds")
    assert rows(out, "window_start") == [(at(0),), (at(30),)]


@pytest.mark.parametrize("size,slide", [("60 seconds", "15 seconds"), ("50 seconds", "12 seconds"),
                                        ("7 seconds", "1 second"), ("20 seconds", "20 seconds")])
def test_panes_give_the_same_hopping_windows(spark, size, slide):
    df = timed(spark, [(i, i * 37 % 200, float(i), f"T{i % 2}") for i in range(60)])
    ours = rows(windows.windowed_average(df, "k", "ts", "v", size, slide))
    plain = (df.groupBy("k", F.window("ts", size, slide).alias("w"))
             .agg(F.sum("v").alias("s"), F.count("v").alias("n"))
             .select("k", "w.start", "w.end", "s", "n", F.col("s") / F.col("n")))
    assert ours == rows(plain)


@pytest.mark.parametrize("width", [1_000_000, 7_000_000, 40_000_000])
def test_sessions_across_blocks_of_time(spark, width):
    df = timed(spark, [(i, (i * i * 7) % 400, float(i), f"T{i % 3}") for i in range(90)])
    ours = rows(windows.session_average(df, "k", "ts", "v", "5 seconds", width=width))
    assert ours == rows(windows.session_average(df, "k", "ts", "v", "5 seconds"))
    assert len(ours) > 20


def test_records_too_late_for_their_range_join_nothing(spark):
    df = timed(spark, [(0, 100, 1.0), (1, 85, 2.0), (2, 80, 3.0), (3, 79.5, 4.0), (4, 101, 5.0)]).withColumn("p", F.lit(0))
    kept = windows.in_time(df, "ts", "p", df.columns[0], "20 seconds")
    assert sorted(r["v"] for r in kept.collect()) == [1.0, 2.0, 5.0]
    wider = windows.in_time(df, "ts", "p", df.columns[0], "20 seconds", "1 second")
    assert sorted(r["v"] for r in wider.collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]


@pytest.mark.parametrize("second,sessions", [(10, 1), (10.001, 2)])
def test_session_gap(spark, second, sessions):
    df = timed(spark, [(0, 0, 1.0), (1, second, 3.0)])
    out = windows.session_average(df, "k", "ts", "v", "10 seconds")
    assert out.count() == sessions
    assert rows(out, "window_end")[-1] == (at(second + 10),)


def test_sessions_equal_the_built_in_ones(spark):
    df = spark.range(400).select(
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 7919 % 5000).alias("ts"),
        F.concat(F.lit("k"), F.col("id") % 3).alias("k"), (F.col("id") % 17).cast("double").alias("v"))
    ours = windows.session_average(df, "k", "ts", "v", "15 seconds")
    theirs = windows.session_average_stream(df, "k", "ts", "v", "15 seconds")
    assert rows(ours, *theirs.columns) == rows(theirs)


LATE = [(0, 0, 1.0), (1, 59, 3.0), (2, 60, 5.0), (3, 30, 100.0), (4, 130, 7.0)]
FINAL = [(at(0), 2, 2.0), (at(60), 1, 5.0)]


@pytest.mark.parametrize("width", [1, 2, 3, 1 << 20])
def test_final_windows_and_late_rows(spark, width):
    df = timed(spark, LATE)
    final = windows.final_windows(df, "k", "ts", "v", "p", "offset", "1 minute", width=width)
    assert rows(final, "window_start", "num_data_points", "average") == FINAL
    late = windows.late_dropped(df, "ts", "p", "offset", "1 minute", width=width)
    assert rows(late, "offset", "stream_time") == [(3, at(60))]


def test_grace_lets_late_rows_in(spark):
    final = windows.final_windows(timed(spark, LATE), "k", "ts", "v", "p", "offset", "1 minute",
                                  grace="30 seconds")
    assert rows(final, "window_start", "num_data_points") == [(at(0), 3)]


def test_each_partition_has_its_clock(spark):
    df = timed(spark, [(0, 100, 1.0, "T", 0), (0, 10, 2.0, "T", 1), (1, 30, 4.0, "T", 0)])
    late = windows.late_dropped(df, "ts", "p", "offset", "1 minute")
    assert rows(late, "p", "offset") == [(0, 1)]


# Joins

def test_join_within_bounds_are_inclusive(spark):
    left = timed(spark, [(0, 0, 1.0), (1, 100, 1.0)])
    right = timed(spark, [(0, 20, 1.0), (1, 21, 1.0), (2, 80, 1.0), (3, 79, 1.0)])
    out = joins.join_within(left, right, "k", "ts", "ts", "20 seconds")
    assert rows(out, "value.turbine_data.ts", "value.weather_data.ts") == [
        (at(0), at(20)), (at(100), at(80))]


@pytest.mark.parametrize("before,after", [("20 seconds", None), ("0 seconds", "7 seconds"),
                                          ("13 seconds", "1 second"), ("0 seconds", "0 seconds")])
def test_join_within_equals_brute_force(spark, before, after):
    def side(seed):
        return spark.range(150).select(
            F.timestamp_seconds(1_704_067_200 + F.col("id") * seed % 400).alias("ts"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
            F.col("id"))
    left, right = side(37), side(53)
    ours = joins.join_within(left, right, "k", "ts", "ts", before, after)
    b, a = (int(x.split()[0]) for x in (before, after or before))
    l, r = left.collect(), right.collect()
    expected = sorted((x.id, y.id) for x in l for y in r if x.k == y.k
                      and -b <= (y.ts - x.ts).total_seconds() <= a)
    assert sorted(tuple(x) for x in ours.select("value.turbine_data.id", "value.weather_data.id").collect()
                  ) == expected


def test_lookup_over_time(spark):
    stream = spark.createDataFrame([(0, "k", "r1"), (2, "k", "r2"), (4, "k", "r3"), (9, "k", "r4")],
                                   "offset BIGINT, key STRING, r STRING")
    table = spark.createDataFrame([(1, "k", "v1"), (3, "k", "v2"), (5, "k", None)],
                                  "offset BIGINT, key STRING, v STRING")
    for width in (1, 2, 1 << 20):
        asof = joins.enrich_as_of(stream, table, "key", "offset", tombstone=F.col("v").isNull(), width=width)
        assert rows(asof, "value.turbine_data.r", "value.master_data.v") == [("r2", "v1"), ("r3", "v2")]
    snapshot = aggregates.latest_by_key(table.filter("offset < 5"), "key")
    now = joins.join_stream_table(stream.filter("offset < 5"), snapshot, "key")
    assert rows(now, "value.turbine_data.r", "value.master_data.v") == [
        ("r1", "v2"), ("r2", "v2"), ("r3", "v2")]


def test_table_table_join(spark):
    status = spark.createDataFrame([(0, "k1", True), (1, "k2", False)], "offset BIGINT, key STRING, on BOOLEAN")
    master = spark.createDataFrame([(0, "k1", "m")], "offset BIGINT, key STRING, name STRING")
    gone = spark.createDataFrame([(0, "k1", "m"), (1, "k1", None)], "offset BIGINT, key STRING, name STRING")
    dead = F.col("name").isNull()
    assert rows(joins.join_tables(status, master, "key", right_tombstone=dead), "key") == [("k1",)]
    assert rows(joins.join_tables(status, gone, "key", right_tombstone=dead), "key") == []


def test_custom_joiner(spark):
    left = spark.createDataFrame([("k", 2)], "key STRING, a INT")
    right = spark.createDataFrame([("k", 5)], "key STRING, b INT")
    out = joins.join_stream_table(left, right, "key", lambda l, r: l["a"] * r["b"])
    assert rows(out) == [("k", 10)]


def test_master_data_drops_bad_and_unknown_keys(spark):
    turbines = spark.createDataFrame([(0, "3", "3"), (1, "x", "3"), (2, "9", "3")], schemas.WIND_TURBINES)
    customers = spark.createDataFrame([(3, "Bulgaria", 220.71)], schemas.CUSTOMERS)
    parks = spark.createDataFrame([(3, "North")], schemas.WIND_PARKS)
    assert rows(joins.join_master_data(turbines, customers, parks)) == [(0, "Bulgaria", "North", 220.71)]


def test_salted_join_equals_plain_join(spark):
    left = skewed(spark).dropna()
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("zz", 4)], "wind_turbine_id STRING, n INT")
    assert skew.hot_keys(left, "wind_turbine_id", 0.3) == ["hot"]
    plain = left.join(right, "wind_turbine_id")
    salted = skew.join_salted(left, right, "wind_turbine_id", "offset", salts=8, share=0.3)
    assert rows(salted, *plain.columns) == rows(plain)
    with pytest.raises(ValueError):
        skew.hot_keys(left, "wind_turbine_id", 0)


# Ledger, outbox, metrics, billing

def test_transfer_lines_and_commit(spark):
    df = spark.createDataFrame([(0, "Alice", "Bob", 70, False), (1, "Eve", "Dave", 5, True)],
                               "offset BIGINT, sender_account STRING, receiver_account STRING, "
                               "amount INT, is_suspicious BOOLEAN")
    lines = ledger.transfer_ledger(df)
    assert rows(lines, "topic", "key", "value", "txn_state", "next_offset") == [
        ("bank-credits", "Alice", "70€", "committed", 1),
        ("bank-credits", "Eve", "5€ <-Suspicious!", "aborted", 2),
        ("bank-debits", "Bob", "70€", "committed", 1),
        ("bank-debits", "Dave", "5€ <-Suspicious!", "aborted", 2)]
    assert rows(ledger.committed_only(lines), "key") == [("Alice",), ("Bob",)]


def test_outbox_event_carries_the_logs_date(spark):
    work = spark.createDataFrame([(7, at(0), 'Oil "change"', 1500.0, 2)],
                                 "turbine_id INT, date TIMESTAMP, actions_performed STRING, "
                                 "maintenance_costs DOUBLE, months_ahead INT")
    log = outbox.maintenance_log(work)
    events = outbox.require_outbox_rows(outbox.outbox_events(log, ["turbine_id", "date"]))
    event = events.first()
    assert (event.aggregatetype, event.aggregateid, event.type) == ("WindTurbine", "7", "MaintenancePerformed")
    assert event.payload == ('{"turbineId":7,"action":"Oil \\"change\\"",'
                             '"nextMaintenance":"2024-03-01 00:00:00"}')
    assert log.first().next_maintenance_date.month == 3
    broken = events.withColumn("payload", F.lit("{bad"))
    assert not outbox.split_events(broken).first().is_valid
    with pytest.raises(Exception, match="not JSON"):
        outbox.require_outbox_rows(broken).collect()


def test_current_time_is_the_default_date(spark):
    work = spark.createDataFrame([(7, "Oil change", 1500.0, 2)],
                                 "turbine_id INT, actions_performed STRING, maintenance_costs DOUBLE, "
                                 "months_ahead INT")
    assert outbox.maintenance_log(work).filter("date > TIMESTAMP '2020-01-01'").count() == 1


def test_change_envelopes(spark):
    inner = '{"op":"%s","before":null,"after":{"aggregateid":"7","type":"MaintenancePerformed","payload":"{}"}}'
    values = [inner % "c", '{"payload":%s}' % (inner % "c"), inner % "u",
              '{"op":"d","before":{"aggregateid":"7"},"after":null}', "{bad", None]
    df = spark.createDataFrame(list(enumerate(values)), "id INT, value STRING")
    assert rows(changes.decode_changes(df), "id", "aggregateid", "payload") == [(0, "7", "{}"), (1, "7", "{}")]


def test_metric_page(spark):
    df = spark.createDataFrame([(0, "T1", "P1", 1.0), (1, "T1", "P1", 2.5)],
                               "offset BIGINT, wind_turbine_id STRING, wind_park_id STRING, current_power DOUBLE")
    page = metrics.with_headers(metrics.metric_lines(df)).orderBy("section", "line")
    assert [r.line for r in page.collect()] == [
        "# HELP power The current power of a wind turbine in W", "# TYPE power counter",
        "power{turbine=T1,windPark=P1} 2.50"]


def test_metric_text(spark, tmp_path):
    df = spark.createDataFrame([(0, "T1", "P1", 1.0)],
                               "offset BIGINT, wind_turbine_id STRING, wind_park_id STRING, current_power DOUBLE")
    metrics.write_metric_text(metrics.metric_lines(df), str(tmp_path / "page"))
    assert spark.read.text(str(tmp_path / "page")).count() == 3


def test_customer_charge_by_hand(spark):
    df = spark.createDataFrame([("Turbine0", at(0), 6e7), ("Turbine0", at(30), 12e7), ("Turbine9", at(0), 1.0)],
                               "wind_turbine_id STRING, timestamp TIMESTAMP, current_power DOUBLE")
    turbines = spark.createDataFrame([(0, "3", "3")], schemas.WIND_TURBINES)
    customers = spark.createDataFrame([(3, "Bulgaria", 200.0)], schemas.CUSTOMERS)
    parks = spark.createDataFrame([(3, "North")], schemas.WIND_PARKS)
    out = customer_charge(df, turbines, customers, parks).first()
    assert (out.customer_name, out.energy_mwh, out.charge) == ("Bulgaria", 1.5, 300.0)


# Properties over the test tables

def test_parts_make_up_the_whole(spark, sf):
    from windflow.plans.views import Views
    v = Views(spark, sf)
    r = v.readings()
    whole = r.count()
    at_limit = r.filter("current_power = 10000").count()
    assert routing.little_wind(r).count() + routing.much_wind(r).count() + at_limit == whole
    lines = ledger.transfer_ledger(v.transfers(), "offset_id")
    assert (ledger.committed_only(lines).count() + lines.filter("txn_state = 'aborted'").count()
            == 2 * v.transfers().count())
    late = v.late_readings()
    args = ("wind_turbine_id", "ts", "current_power")
    final = windows.final_windows(late, *args, "partition_id", "offset_id", "1 hour")
    every = windows.windowed_average(late, *args, "1 hour").select("wind_turbine_id", "window_start")
    assert final.select("wind_turbine_id", "window_start").subtract(every).count() == 0
    assert 0 < final.count() < every.count()
