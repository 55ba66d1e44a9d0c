"""The registered queries: each operator on the whole tables, beside the SQL that checks it.

Sizes are chosen for the tables, where a turbine reports about every few hours: one-hour windows
and twenty-minute joins instead of the operators' defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windflow.functions.codecs import Codec, decode_json, decoded, encode_records as to_records
from windflow.functions.evolution import by_writer, framed_json
from windflow.functions.hashing import default_partition
from windflow.functions.power import convert_power as rescale
from windflow.functions.power import clamp, power_curve as curve
from windflow.functions.text import turbine_key
from windflow.operators import aggregates, joins, ledger, outbox, routing, windows
from windflow.plans import billing
from windflow.plans.views import Views, with_views
from windflow.schemas import OUTBOX_EVENT, READING, TRANSFER, read_together, struct_of
from windflow.sources import avro, changes, metrics, topic_log

Query = Callable[[SparkSession, str], DataFrame]

# Offsets in a block: so few that every key crosses blocks in the tables.
SMALL_BLOCK = 512
# A share of rows that some turbines exceed in the tables, so that salting takes place.
HOT_SHARE = 0.001

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str, *views: str):
    """Register a function of `Views` under `name`, with its checking SQL."""
    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Views(spark, folder))
        ORACLE[name] = with_views(sql, *views) if views else sql
        return build
    return register


# Sources

@query("topic_scan", """
SELECT topic, partition_id, offset_id, record_key, record_value->>'wind_turbine_id' AS wind_turbine_id,
       record_value->>'wind_park_id' AS wind_park_id,
       CAST(record_value->>'current_power' AS DOUBLE) AS current_power
FROM raw_readings WHERE record_value IS NOT NULL AND record_value <> '{bad'""", "raw_readings")
def topic_scan(v: Views) -> DataFrame:
    return decoded(v.raw_readings().drop("ts"), Codec(READING), "record_value")


@query("multi_topic_union", """
SELECT 'wind-turbine-data' AS topic, offset_id, wind_turbine_id FROM readings
UNION ALL SELECT 'weather-data', offset_id, wind_turbine_id FROM weather
UNION ALL SELECT 'wind-turbine-status', offset_id, wind_turbine_id FROM turbine_status""",
       "readings", "weather", "turbine_status")
def multi_topic_union(v: Views) -> DataFrame:
    return topic_log.union_topics({
        "wind-turbine-data": v.readings(), "weather-data": v.weather(),
        "wind-turbine-status": v.turbine_status()}).select("topic", "offset_id", "wind_turbine_id")


@query("offset_range", """
SELECT partition_id, offset_id, wind_turbine_id, current_power FROM readings
WHERE partition_id = 0 OR (partition_id = 1 AND offset_id >= 500)
   OR (partition_id = 3 AND offset_id >= 250)""", "readings")
def offset_range(v: Views) -> DataFrame:
    start = {0: topic_log.EARLIEST, 1: 500, 2: topic_log.LATEST, 3: 250}
    return topic_log.offset_range(v.readings(), start, partition="partition_id",
                                  offset="offset_id").select(
        "partition_id", "offset_id", "wind_turbine_id", "current_power")


@query("masterdata_join", "SELECT * FROM master", "master")
def masterdata_join(v: Views) -> DataFrame:
    return joins.join_master_data(v.wind_turbines(), v.customers(), v.wind_parks())


@query("outbox_decode", """
SELECT offset_id, aggregatetype, aggregateid, type, payload,
       concat_ws('-', digits[1:8], digits[9:12], digits[13:16], digits[17:20], digits[21:32]) AS payloadid
FROM outbox WHERE offset_id % 7 <> 0""", "outbox")
def outbox_decode(v: Views) -> DataFrame:
    events = outbox.outbox_events(outbox.maintenance_log(v.maintenance()), ["offset_id"])
    row = F.struct(*OUTBOX_EVENT.names)
    # Every seventh change is a deletion; every second one comes in an outer payload.
    deleted = F.col("offset_id") % 7 == 0
    envelope = F.struct(F.when(deleted, "d").otherwise("c").alias("op"),
                        F.when(deleted, row).alias("before"), F.when(~deleted, row).alias("after"))
    wrapped = F.to_json(F.struct(envelope.alias("payload")))
    captured = events.select("offset_id", F.when(F.col("offset_id") % 2 == 0, wrapped)
                             .otherwise(F.to_json(envelope)).alias("value"))
    return changes.decode_changes(captured)


# Sinks

@query("encode_records", """
SELECT 'wind-turbine-data' AS topic, wind_turbine_id AS key,
       CASE WHEN offset_id % 5 = 0 THEN concat('{"wind_turbine_id":"', wind_turbine_id, '"')
            ELSE concat('{"wind_turbine_id":"', wind_turbine_id, '","wind_park_id":"', wind_park_id, '"')
       END AS ids, current_power
FROM readings""", "readings")
def encode_records(v: Views) -> DataFrame:
    # Number text differs between engines, so the power is compared as a number. Every fifth
    # reading has no park: null fields are left out of the text.
    some = v.readings().withColumn(
        "wind_park_id", F.when(F.col("offset_id") % 5 != 0, F.col("wind_park_id")))
    encoded = to_records(some, Codec(READING), "wind-turbine-data", F.col("wind_turbine_id"))
    return encoded.select("topic", "key",
                          F.substring_index("value", ',"current_power"', 1).alias("ids"),
                          F.get_json_object("value", "$.current_power").cast("double")
                          .alias("current_power"))


@query("encode_transfers", """
SELECT 'bank-transactions' AS topic, CAST(NULL AS VARCHAR) AS key,
       concat('{"sender_account":"', sender_account, '","receiver_account":"', receiver_account,
              '","amount":', amount, ',"is_suspicious":', is_suspicious, '}') AS value
FROM transfers""", "transfers")
def encode_transfers(v: Views) -> DataFrame:
    return to_records(v.transfers(), Codec(TRANSFER), "bank-transactions")


@query("running_avg_changelog", """
SELECT offset_id, wind_turbine_id, sum(current_power) OVER w AS sum_power,
       count(*) OVER w AS num_data_points, sum(current_power) OVER w / count(*) OVER w AS average
FROM readings
WINDOW w AS (PARTITION BY wind_turbine_id ORDER BY offset_id ROWS UNBOUNDED PRECEDING)""", "readings")
def running_avg_changelog(v: Views) -> DataFrame:
    rows = v.readings().select("offset_id", "wind_turbine_id", "current_power")
    running = aggregates.running_average(rows, "wind_turbine_id", "current_power", "offset_id", width=SMALL_BLOCK)
    return running.drop("current_power")


@query("park_avg_changelog", """
SELECT offset_id, wind_park_id, sum(current_power) OVER w AS sum_power, count(*) OVER w AS num_data_points,
       sum(current_power) OVER w / count(*) OVER w AS average
FROM late_readings
WINDOW w AS (PARTITION BY wind_park_id ORDER BY ts, offset_id ROWS UNBOUNDED PRECEDING)""", "late_readings")
def park_avg_changelog(v: Views) -> DataFrame:
    """Every update of a park's average. Its turbines write to all log partitions, so time orders them."""
    rows = v.late_readings().select("offset_id", "ts", "wind_park_id", "current_power")
    running = aggregates.running_average(rows, "wind_park_id", "current_power", "ts", ["offset_id"],
                                         width=3_600_000_000)
    return running.drop("current_power", "ts")


@query("transfer_ledger", """
SELECT offset_id, topic, key, concat(amount, '€', CASE WHEN is_suspicious THEN ' <-Suspicious!' ELSE '' END) AS value,
       CASE WHEN is_suspicious THEN 'aborted' ELSE 'committed' END AS txn_state,
       offset_id + 1 AS next_offset
FROM lines""", "lines")
def transfer_ledger(v: Views) -> DataFrame:
    return ledger.transfer_ledger(v.transfers(), "offset_id")


@query("committed_only", """
SELECT offset_id, topic, key, concat(amount, '€') AS value, offset_id + 1 AS next_offset
FROM lines WHERE NOT is_suspicious""", "lines")
def committed_only(v: Views) -> DataFrame:
    lines = ledger.transfer_ledger(v.transfers(), "offset_id")
    return ledger.committed_only(lines).drop("txn_state")


@query("transfer_lines", """
SELECT offset_id, is_suspicious, topic, key,
       concat(amount, '€', CASE WHEN is_suspicious THEN ' <-Suspicious!' ELSE '' END) AS value
FROM lines""", "lines")
def transfer_lines(v: Views) -> DataFrame:
    return ledger.transfer_lines(v.transfers())


@query("maintenance_log", """
SELECT offset_id, turbine_id, date, actions_performed, date + to_months(months_ahead) AS next_maintenance_date,
       maintenance_costs, CAST(NULL AS VARCHAR) AS remarks
FROM maintenance""", "maintenance")
def maintenance_log(v: Views) -> DataFrame:
    return outbox.maintenance_log(v.maintenance())


@query("outbox_events", """
SELECT offset_id, aggregatetype, aggregateid, type, payload,
       concat_ws('-', digits[1:8], digits[9:12], digits[13:16], digits[17:20], digits[21:32]) AS payloadid,
       json_valid(payload) AS is_valid
FROM outbox""", "outbox")
def outbox_events(v: Views) -> DataFrame:
    events = outbox.outbox_events(outbox.maintenance_log(v.maintenance()), ["offset_id"])
    return outbox.split_events(events)


@query("metric_lines", """
SELECT wind_turbine_id, format('power{{turbine={},windPark={}}} {:.2f}', wind_turbine_id,
       arg_max(wind_park_id, offset_id), arg_max(current_power, offset_id)) AS line
FROM readings GROUP BY wind_turbine_id""", "readings")
def metric_lines(v: Views) -> DataFrame:
    return metrics.metric_lines(v.readings(), order="offset_id")


# Projections

@query("convert_power", """
SELECT offset_id, wind_turbine_id, current_power / 1e6 AS current_power FROM readings""",
       "readings")
def convert_power(v: Views) -> DataFrame:
    in_mw = routing.map_values(v.readings(), lambda p: rescale(p, "W", "MW"), "current_power")
    return in_mw.select("offset_id", "wind_turbine_id", "current_power")


@query("power_curve", """
SELECT offset_id, CASE WHEN wind_speed IS NOT NULL THEN least(30.0, greatest(0.0, wind_speed)) END::DOUBLE AS wind_speed,
       round(CASE WHEN wind_speed IS NULL THEN NULL WHEN least(30.0, wind_speed) < 3 OR least(30.0, wind_speed) >= 25 THEN 0.0
                  WHEN least(30.0, wind_speed) >= 12 THEN 7000000.0
                  ELSE 7000000.0 * pow((least(30.0, wind_speed) - 3.0) / 9.0, 3) END::DOUBLE, 3) AS power
FROM wind_speeds""", "wind_speeds")
def power_curve(v: Views) -> DataFrame:
    speed = clamp(F.col("wind_speed"), 0.0, 30.0)
    return v.wind_speeds().select(
        "offset_id", speed.alias("wind_speed"),
        F.round(curve(speed, F.lit(7_000_000.0)), 3).alias("power"))


@query("decode_json", """
SELECT offset_id, CASE WHEN record_value IS NULL THEN 'tombstone' WHEN record_value = '{bad' THEN 'rejected'
                       ELSE 'ok' END AS state,
       CASE WHEN record_value <> '{bad' THEN record_value->>'wind_turbine_id' END AS wind_turbine_id,
       CASE WHEN record_value <> '{bad' THEN record_value->>'wind_park_id' END AS wind_park_id,
       CASE WHEN record_value <> '{bad' THEN CAST(record_value->>'current_power' AS DOUBLE) END AS current_power
FROM raw_readings""", "raw_readings")
def decode(v: Views) -> DataFrame:
    return decode_json(v.raw_readings(), Codec(READING), "record_value").select(
        "offset_id", "state", "record.*")


# Filters and routing

@query("little_wind", "SELECT * FROM readings WHERE current_power < 10000", "readings")
def little_wind(v: Views) -> DataFrame:
    return routing.little_wind(v.readings())


@query("much_wind", "SELECT * FROM readings WHERE current_power > 10000", "readings")
def much_wind(v: Views) -> DataFrame:
    return routing.much_wind(v.readings())


@query("route_branches", """
SELECT offset_id, wind_turbine_id, current_power,
       CASE WHEN current_power < 10000 THEN 'little-wind' ELSE 'much-wind' END AS topic
FROM readings""", "readings")
def route_branches(v: Views) -> DataFrame:
    return routing.route_wind(v.readings().select("offset_id", "wind_turbine_id", "current_power"))


@query("heavy_partition", """
SELECT offset_id, record_key,
       CAST(CASE WHEN starts_with(record_key, 'HeavyProducer_') THEN h % 4 ELSE 4 + h % 8 END AS INT) AS partition
FROM (SELECT *, CAST('0x' || substr(md5(record_key), 1, 8) AS BIGINT) AS h FROM keyed_producers)""",
       "keyed_producers")
def heavy_partition(v: Views) -> DataFrame:
    return routing.partition_heavy(v.keyed_producers(), 12, key="record_key", hash_name="md5")


# Murmur2 over the key's bytes, four at a time, lowest byte first; products fit in 64 bits.
_MURMUR2_SQL = """
, bytes AS (SELECT offset_id, record_key, hex(encode(record_key)) AS d FROM keyed_producers),
words AS (
  SELECT offset_id, record_key, octet_length(encode(record_key))::BIGINT AS n,
         list_transform(range(0, length(d) // 8), lambda i:
           ('0x' || d[8*i+7:8*i+8] || d[8*i+5:8*i+6] || d[8*i+3:8*i+4] || d[8*i+1:8*i+2])::BIGINT) AS w,
         d[8 * (length(d) // 8) + 1:] AS t
  FROM bytes),
mixed AS (
  SELECT *, list_transform(list_transform(w, lambda k: (k * 1540483477) & 4294967295),
    lambda k: (xor(k, k >> 24) * 1540483477) & 4294967295) AS ks
  FROM words),
body AS (
  SELECT offset_id, record_key, t,
    list_reduce(list_prepend(xor(2538058380::BIGINT, n), ks),
                lambda h, k: xor((h * 1540483477) & 4294967295, k)) AS h
  FROM mixed),
tail AS (
  SELECT offset_id, record_key,
    CASE WHEN t = '' THEN h
         ELSE (xor(h, ('0x' || rpad(t, 8, '0')[7:8] || rpad(t, 8, '0')[5:6] || rpad(t, 8, '0')[3:4]
                       || rpad(t, 8, '0')[1:2])::BIGINT) * 1540483477) & 4294967295 END AS h
  FROM body),
last AS (SELECT offset_id, record_key, (xor(h, h >> 13) * 1540483477) & 4294967295 AS h FROM tail)
, hashed AS (SELECT offset_id, record_key, xor(h, h >> 15) AS h FROM last)
"""


@query("heavy_partition_client", _MURMUR2_SQL + """
, absolute AS (SELECT *, abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) AS a FROM hashed)
SELECT offset_id, record_key,
       CAST(CASE WHEN starts_with(record_key, 'HeavyProducer_') THEN a % 4 ELSE 4 + a % 8 END AS INT) AS partition
FROM absolute""", "keyed_producers")
def heavy_partition_client(v: Views) -> DataFrame:
    """The heavy-producer rule with the client library's own hash."""
    return routing.partition_heavy(v.keyed_producers(), 12, key="record_key")


@query("default_partition", _MURMUR2_SQL + """
SELECT offset_id, record_key, CAST((h & 2147483647) % 12 AS INT) AS partition FROM hashed""", "keyed_producers")
def default_key_partition(v: Views) -> DataFrame:
    return routing.partition_by(v.keyed_producers(), lambda key: default_partition(key, 12),
                                "record_key")


# Aggregations

@query("count_by_key", """
SELECT record_key, count(*) AS count FROM raw_readings WHERE record_value IS NOT NULL
GROUP BY record_key""", "raw_readings")
def count_by_key(v: Views) -> DataFrame:
    return aggregates.count_by_key(v.raw_readings(), "record_key", "record_value")


@query("turbine_average", """
SELECT wind_turbine_id, sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM readings GROUP BY wind_turbine_id""", "readings")
def turbine_average(v: Views) -> DataFrame:
    return aggregates.average_by_key(v.readings(), "wind_turbine_id", "current_power")


@query("park_average", """
SELECT wind_park_id, sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM readings GROUP BY wind_park_id""", "readings")
def park_average(v: Views) -> DataFrame:
    keyed = routing.select_key(v.readings(), F.col("wind_park_id"))
    averages = aggregates.average_by_key(keyed, "key", "current_power")
    return averages.withColumnRenamed("key", "wind_park_id")


@query("latest_by_key", """
SELECT wind_turbine_id, max(offset_id) AS offset_id, arg_max(customer_name, offset_id) AS customer_name
FROM master_changes GROUP BY wind_turbine_id HAVING NOT arg_max(is_deleted, offset_id)""",
       "master_changes")
def latest_by_key(v: Views) -> DataFrame:
    return aggregates.latest_by_key(v.master_changes(), "wind_turbine_id", "offset_id",
                                    F.col("is_deleted")).select(
        "wind_turbine_id", "offset_id", "customer_name")


@query("custom_fold", """
, steps AS (
  SELECT wind_turbine_id, offset_id, current_power,
         current_power - lag(current_power) OVER (PARTITION BY wind_turbine_id ORDER BY offset_id) AS rise
  FROM readings)
SELECT wind_turbine_id, count(*) AS num_data_points, arg_min(current_power, offset_id) AS first,
       arg_max(current_power, offset_id) AS last, max(rise) AS rise
FROM steps GROUP BY wind_turbine_id""", "readings")
def custom_fold(v: Views) -> DataFrame:
    """The largest rise between neighbours, which depends on the order; blocks so small that they merge."""
    folded = aggregates.custom_fold(v.readings(), "wind_turbine_id", aggregates.largest_rise_fold("current_power"),
                                    ["current_power"], "offset_id", width=SMALL_BLOCK)
    return folded.select("wind_turbine_id", "result.*")


@query("custom_fold_average", """
SELECT wind_turbine_id, sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM readings GROUP BY wind_turbine_id""", "readings")
def custom_fold_average(v: Views) -> DataFrame:
    fold = aggregates.running_average_fold("current_power")
    folded = aggregates.custom_fold(v.readings(), "wind_turbine_id", fold, ["current_power"], "offset_id")
    return folded.select("wind_turbine_id", "result.*")


@query("moving_average", """
SELECT offset_id, wind_turbine_id, sum(current_power) OVER w / count(*) OVER w AS moving_average
FROM readings
WINDOW w AS (PARTITION BY wind_turbine_id ORDER BY offset_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""", "readings")
def moving_average(v: Views) -> DataFrame:
    rows = v.readings().select("offset_id", "wind_turbine_id", "current_power")
    return aggregates.moving_average(rows, "wind_turbine_id", "current_power", 5, "offset_id",
                                     width=SMALL_BLOCK).select(
        "offset_id", "wind_turbine_id", "moving_average")


# Windows

@query("energy_per_window", """
SELECT wind_turbine_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       sum(current_power) / count(*) AS energy_wh,
       sum(current_power) / count(*) / 1e6 AS generated_power_in_mwh
FROM readings GROUP BY ALL""", "readings")
def energy_per_window(v: Views) -> DataFrame:
    energy = windows.energy_per_window(v.readings(), "wind_turbine_id", "ts", "current_power", "1 hour")
    return energy.select("wind_turbine_id", "window_start", "window_end", "energy_wh",
                         "generated_power_in_mwh")


@query("hopping_average", """
SELECT wind_turbine_id, start AS window_start, start + INTERVAL 1 HOUR AS window_end,
       sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS start
      FROM readings, (VALUES (0), (1)) AS steps(k))
GROUP BY wind_turbine_id, start""", "readings")
def hopping_average(v: Views) -> DataFrame:
    return windows.windowed_average(v.readings(), "wind_turbine_id", "ts", "current_power",
                                              "1 hour", "30 minutes")


@query("hopping_panes", """
SELECT wind_park_id, start AS window_start, start + INTERVAL 2 HOUR AS window_end,
       sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS start
      FROM readings, range(8) AS steps(k))
GROUP BY wind_park_id, start""", "readings")
def hopping_panes(v: Views) -> DataFrame:
    return windows.windowed_average(v.readings(), "wind_park_id", "ts", "current_power", "2 hours",
                                    "15 minutes")


@query("session_average", """
, marked AS (
  SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY wind_turbine_id ORDER BY ts) + INTERVAL 1 HOUR, true)
         AS starts
  FROM late_readings),
numbered AS (
  SELECT *, sum(starts::INT) OVER (PARTITION BY wind_turbine_id ORDER BY ts
                                   RANGE UNBOUNDED PRECEDING) AS session
  FROM marked)
SELECT wind_turbine_id, min(ts) AS window_start, max(ts) + INTERVAL 1 HOUR AS window_end,
       sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM numbered GROUP BY wind_turbine_id, session""", "late_readings")
def session_average(v: Views) -> DataFrame:
    return windows.session_average(v.late_readings(), "wind_turbine_id", "ts",
                                             "current_power", "1 hour")


@query("final_windows", """
, clocks AS (SELECT partition_id, max(ts) AS clock FROM late_readings GROUP BY partition_id)
SELECT t.partition_id, wind_turbine_id, window_start, window_end,
       sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM timed t JOIN clocks c ON t.partition_id = c.partition_id
WHERE stream_time < window_end AND window_end <= clock
GROUP BY t.partition_id, wind_turbine_id, window_start, window_end""", "timed")
def final_windows(v: Views) -> DataFrame:
    return windows.final_windows(v.late_readings(), "wind_turbine_id", "ts", "current_power",
                                           "partition_id", "offset_id", "1 hour", width=SMALL_BLOCK)


@query("final_hopping", """
, clocks AS (SELECT partition_id, max(ts) AS clock FROM late_readings GROUP BY partition_id),
hops AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS start
         FROM timed, (VALUES (0), (1)) AS steps(k))
SELECT h.partition_id, wind_turbine_id, start AS window_start, start + INTERVAL 1 HOUR AS window_end,
       sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM hops h JOIN clocks c ON h.partition_id = c.partition_id
WHERE stream_time < start + INTERVAL 1 HOUR AND start + INTERVAL 1 HOUR <= clock
GROUP BY h.partition_id, wind_turbine_id, start""", "timed")
def final_hopping(v: Views) -> DataFrame:
    final = windows.final_hopping_windows(v.late_readings(), "wind_turbine_id", "ts", "current_power", "partition_id",
                                          "offset_id", "1 hour", "30 minutes", width=SMALL_BLOCK)
    return final.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("final_sessions", """
, clocks AS (SELECT partition_id, max(ts) AS clock FROM late_readings GROUP BY partition_id),
marked AS (
  SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY partition_id, wind_turbine_id ORDER BY ts) + INTERVAL 1 HOUR,
                     true) AS starts
  FROM timed WHERE stream_time < ts + INTERVAL 1 HOUR),
numbered AS (
  SELECT *, sum(starts::INT) OVER (PARTITION BY partition_id, wind_turbine_id ORDER BY ts
                                   RANGE UNBOUNDED PRECEDING) AS session
  FROM marked)
SELECT n.partition_id, wind_turbine_id, min(ts) AS window_start, max(ts) + INTERVAL 1 HOUR AS window_end,
       sum(current_power) AS sum_power, count(*) AS num_data_points,
       sum(current_power) / count(*) AS average
FROM numbered n JOIN clocks c ON n.partition_id = c.partition_id
GROUP BY n.partition_id, wind_turbine_id, session, clock
HAVING max(ts) + INTERVAL 2 HOUR <= clock""", "timed")
def final_sessions(v: Views) -> DataFrame:
    return windows.final_sessions(v.late_readings(), "wind_turbine_id", "ts", "current_power", "partition_id",
                                  "offset_id", "1 hour", width=SMALL_BLOCK)


@query("late_dropped", """
SELECT offset_id, partition_id, wind_turbine_id, ts, window_start, window_end, stream_time
FROM timed WHERE stream_time >= window_end""", "timed")
def late_dropped(v: Views) -> DataFrame:
    return windows.late_dropped(v.late_readings(), "ts", "partition_id", "offset_id", "1 hour",
                                width=SMALL_BLOCK).select(
        "offset_id", "partition_id", "wind_turbine_id", "ts", "window_start", "window_end", "stream_time")


# Joins

@query("enrich_readings", """
SELECT r.offset_id, r.wind_turbine_id, r.current_power, m.id, m.customer_name, m.wind_park_name
FROM readings r JOIN master m ON r.wind_turbine_id = concat('Turbine', m.id)""", "readings", "master")
def enrich_readings(v: Views) -> DataFrame:
    master = joins.join_master_data(v.wind_turbines(), v.customers(), v.wind_parks())
    table = master.withColumn("wind_turbine_id", turbine_key(F.col("id")))
    joined = joins.join_stream_table(v.readings(), table, "wind_turbine_id")
    return joined.select("value.turbine_data.offset_id", "value.turbine_data.wind_turbine_id",
                         "value.turbine_data.current_power", "value.master_data.id",
                         "value.master_data.customer_name", "value.master_data.wind_park_name")


@query("enrich_salted", """
SELECT r.offset_id, r.wind_turbine_id, r.current_power, m.id, m.customer_name
FROM readings r JOIN master m ON r.wind_turbine_id = concat('Turbine', m.id)""", "readings", "master")
def enrich_salted(v: Views) -> DataFrame:
    master = joins.join_master_data(v.wind_turbines(), v.customers(), v.wind_parks())
    table = master.withColumn("wind_turbine_id", turbine_key(F.col("id")))
    joined = joins.join_stream_table(v.readings(), table, "wind_turbine_id", hot_share=HOT_SHARE,
                                     spread="offset_id")
    return joined.select("value.turbine_data.offset_id", "value.turbine_data.wind_turbine_id",
                         "value.turbine_data.current_power", "value.master_data.id",
                         "value.master_data.customer_name")


@query("enrich_asof", """
SELECT r.offset_id, r.wind_turbine_id, r.current_power, m.customer_name
FROM readings r ASOF JOIN master_changes m
  ON r.wind_turbine_id = m.wind_turbine_id AND r.offset_id >= m.offset_id
WHERE NOT m.is_deleted""", "readings", "master_changes")
def enrich_asof(v: Views) -> DataFrame:
    readings = v.readings().select("offset_id", "wind_turbine_id", "current_power")
    joined = joins.enrich_as_of(readings, v.master_changes(), "wind_turbine_id", "offset_id",
                                tombstone=F.col("is_deleted"), width=SMALL_BLOCK)
    return joined.select("value.turbine_data.*", "value.master_data.customer_name")


@query("enrich_asof_time", """
SELECT r.offset_id, r.wind_turbine_id, r.current_power, m.customer_name
FROM late_readings r ASOF JOIN
     (SELECT wind_turbine_id, ts, arg_max(customer_name, offset_id) AS customer_name,
             arg_max(is_deleted, offset_id) AS is_deleted
      FROM master_changes GROUP BY wind_turbine_id, ts) m
  ON r.wind_turbine_id = m.wind_turbine_id AND r.ts >= m.ts
WHERE NOT m.is_deleted""", "late_readings", "master_changes")
def enrich_asof_time(v: Views) -> DataFrame:
    """Two logs with offsets of their own: only time orders them. Blocks of two days."""
    readings = v.late_readings().select("offset_id", "ts", "wind_turbine_id", "current_power")
    changes_by_time = v.master_changes().select("wind_turbine_id", "ts", "customer_name", "is_deleted")
    joined = joins.enrich_as_of(readings, changes_by_time, "wind_turbine_id", "ts",
                                tombstone=F.col("is_deleted"), width=2 * 86_400_000_000)
    return joined.select("value.turbine_data.offset_id", "wind_turbine_id", "value.turbine_data.current_power",
                         "value.master_data.customer_name")


@query("enrich_asof_ties", """
SELECT r.offset_id, r.wind_turbine_id, r.current_power, m.customer_name
FROM late_readings r ASOF JOIN
     (SELECT wind_turbine_id, date_trunc('day', ts) AS day, arg_max(customer_name, offset_id) AS customer_name,
             arg_max(is_deleted, offset_id) AS is_deleted
      FROM master_changes GROUP BY 1, 2) m
  ON r.wind_turbine_id = m.wind_turbine_id AND r.ts >= m.day
WHERE NOT m.is_deleted""", "late_readings", "master_changes")
def enrich_asof_ties(v: Views) -> DataFrame:
    """Master data that changes several times at one time: the last change by offset counts."""
    readings = v.late_readings().select("offset_id", "ts", "wind_turbine_id", "current_power")
    daily = v.master_changes().select("wind_turbine_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"),
                                      F.col("offset_id").alias("change"), "customer_name", "is_deleted")
    joined = joins.enrich_as_of(readings, daily, "wind_turbine_id", "ts", tombstone=F.col("is_deleted"),
                                width=2 * 86_400_000_000, ties=["change"])
    return joined.select("value.turbine_data.offset_id", "wind_turbine_id", "value.turbine_data.current_power",
                         "value.master_data.customer_name")


@query("status_masterdata", """
SELECT s.wind_turbine_id, s.is_online, s.status, m.customer_name
FROM (SELECT wind_turbine_id, arg_max(is_online, offset_id) AS is_online,
             arg_max(status, offset_id) AS status FROM turbine_status GROUP BY 1) s
JOIN (SELECT wind_turbine_id, arg_max(customer_name, offset_id) AS customer_name FROM master_changes
      GROUP BY 1 HAVING NOT arg_max(is_deleted, offset_id)) m USING (wind_turbine_id)""",
       "turbine_status", "master_changes")
def status_masterdata(v: Views) -> DataFrame:
    joined = joins.join_tables(v.turbine_status(), v.master_changes(), "wind_turbine_id", "offset_id",
                               right_tombstone=F.col("is_deleted"))
    return joined.select("wind_turbine_id", "value.turbine_status.is_online",
                         "value.turbine_status.status", "value.master_data.customer_name")


@query("readings_weather", """
SELECT r.offset_id, r.wind_turbine_id, r.current_power, w.offset_id AS weather_offset_id, w.wind_speed
FROM readings r JOIN weather w ON r.wind_turbine_id = w.wind_turbine_id
 AND w.ts BETWEEN r.ts - INTERVAL 20 MINUTE AND r.ts + INTERVAL 20 MINUTE""", "readings", "weather")
def readings_weather(v: Views) -> DataFrame:
    joined = joins.join_within(v.readings(), v.weather(), "wind_turbine_id", "ts", "ts", "20 minutes")
    return joined.select("value.turbine_data.offset_id", "wind_turbine_id",
                         "value.turbine_data.current_power",
                         F.col("value.weather_data.offset_id").alias("weather_offset_id"),
                         "value.weather_data.wind_speed")


@query("readings_weather_late", """
, weather_timed AS (
  SELECT *, max(ts) OVER (PARTITION BY turbine_id % 4 ORDER BY offset_id ROWS UNBOUNDED PRECEDING) AS stream_time
  FROM weather)
SELECT r.offset_id, r.wind_turbine_id, r.current_power, w.offset_id AS weather_offset_id, w.wind_speed
FROM timed r JOIN weather_timed w ON r.wind_turbine_id = w.wind_turbine_id
 AND w.ts BETWEEN r.ts - INTERVAL 20 MINUTE AND r.ts + INTERVAL 20 MINUTE
WHERE r.stream_time < r.ts + INTERVAL 20 MINUTE AND w.stream_time < w.ts + INTERVAL 20 MINUTE""", "timed", "weather")
def readings_weather_late(v: Views) -> DataFrame:
    """The time-range join without grace: records that come too late for their range join nothing."""
    readings = windows.in_time(v.late_readings(), "ts", "partition_id", "offset_id", "20 minutes", width=SMALL_BLOCK)
    weather = windows.in_time(v.weather().withColumn("partition_id", F.pmod("turbine_id", F.lit(4))), "ts",
                              "partition_id", "offset_id", "20 minutes", width=SMALL_BLOCK)
    joined = joins.join_within(readings, weather, "wind_turbine_id", "ts", "ts", "20 minutes")
    return joined.select("value.turbine_data.offset_id", "wind_turbine_id", "value.turbine_data.current_power",
                         F.col("value.weather_data.offset_id").alias("weather_offset_id"),
                         "value.weather_data.wind_speed")


# Limits, evolution, billing

@query("first_n", "SELECT * FROM transfers ORDER BY offset_id LIMIT 50", "transfers")
def first_n(v: Views) -> DataFrame:
    return routing.first_n(v.transfers(), 50, "offset_id")


@query("evolve_union", """
SELECT offset_id, wind_turbine_id, wind_park_id, current_power,
       CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN concat('Maker', offset_id % 5) END AS manufacturer
FROM readings""", "readings")
def evolve_union(v: Views) -> DataFrame:
    columns = ["offset_id", "wind_turbine_id", "wind_park_id", "current_power"]
    switch = F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    old = v.readings().filter(F.col("ts") < switch).select(*columns)
    new = v.readings().filter(F.col("ts") >= switch).select(*columns, F.concat(
        F.lit("Maker"), (F.col("offset_id") % 5).cast("string")).alias("manufacturer"))
    return read_together(old, new)


@query("evolve_by_writer", """
SELECT offset_id, wind_turbine_id, current_power,
       CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 'Windpark?' ELSE wind_park_id END AS wind_park_id,
       CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN concat('Maker', offset_id % 5) END AS manufacturer
FROM readings""", "readings")
def evolve_by_writer(v: Views) -> DataFrame:
    """Three versions in one topic, told apart by the schema id in front of each value."""
    versions = {7: struct_of("wind_turbine_id STRING, current_power INT"),
                8: struct_of("wind_turbine_id STRING, current_power BIGINT, wind_park_id STRING"),
                12: struct_of("wind_turbine_id STRING, wind_park_id STRING, current_power DOUBLE, manufacturer STRING")}
    rows = v.readings().withColumn("manufacturer", F.concat(F.lit("Maker"), (F.col("offset_id") % 5).cast("string")))
    value = F.when(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-11 00:00:00'"), framed_json(Codec(versions[7]), 7)).when(
        F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-21 00:00:00'"), framed_json(Codec(versions[8]), 8)).otherwise(
        framed_json(Codec(versions[12]), 12))
    topic = rows.select("offset_id", value.alias("value"))
    record = by_writer(avro.payload(F.col("value")).cast("string"), avro.schema_id(F.col("value")), versions,
                       versions[12], {"wind_park_id": "Windpark?"})
    return topic.select("offset_id", F.explode(F.array(record)).alias("r")).select("offset_id", "r.*")


@query("customer_charge", """
, energy AS (
  SELECT wind_turbine_id, time_bucket(INTERVAL 1 HOUR, ts) AS hour,
         (2 * sum(current_power)::HUGEINT * 1000000 + count(*)) // (2 * count(*)) AS uwh
  FROM readings GROUP BY ALL)
SELECT m.customer_name, round(sum(e.uwh)::DECIMAL(24,0) * 0.000000000001::DECIMAL(12,12), 4)::DOUBLE AS energy_mwh,
       round(sum(e.uwh::DECIMAL(22,0) * m.price_per_mwh::DECIMAL(12,4))::DECIMAL(26,4) * 0.000000000001::DECIMAL(12,12), 4)::DOUBLE AS charge
FROM energy e JOIN master m ON e.wind_turbine_id = concat('Turbine', m.id)
GROUP BY m.customer_name""", "readings", "master")
def customer_charge(v: Views) -> DataFrame:
    charge = billing.customer_charge(v.readings(), v.wind_turbines(), v.customers(), v.wind_parks(),
                                     "ts", "1 hour")
    return charge.select("customer_name", F.round("energy_mwh", 4).cast("double").alias("energy_mwh"),
                         F.round("charge", 4).cast("double").alias("charge"))
