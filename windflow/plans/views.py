"""The wind-farm tables, derived from the benchmark tables.

Every view covers its whole base table or one topic of it. `SQL` holds the same views for the
checking database, which only knows the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windflow.functions.power import convert_power
from windflow.functions.text import park_key, turbine_key
from windflow.schemas import TOPICS

JITTER_SECONDS = 7200


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def readings(self) -> DataFrame:
        """One reading per event; `offset_id` is the arrival order, `partition_id` the partition.

        Power comes in whole watts: sums are then exact, whatever order they are added in.
        """
        return self._table("events").select(
            F.col("event_id").alias("offset_id"),
            F.pmod("user_id", F.lit(4)).cast("int").alias("partition_id"), "ts",
            turbine_key(F.col("user_id")).alias("wind_turbine_id"),
            park_key(F.col("user_id")).alias("wind_park_id"),
            F.round(convert_power(F.col("value"), "kW", "W")).alias("current_power"))

    def late_readings(self, arrival: str | None = None) -> DataFrame:
        """The same, with event times up to two hours behind their arrival, itself kept if named."""
        readings = self.readings()
        if arrival:
            readings = readings.withColumn(arrival, F.col("ts"))
        return readings.withColumn(
            "ts", F.expr(f"ts - make_dt_interval(0, 0, 0, (offset_id * 7919) % {JITTER_SECONDS})"))

    def raw_readings(self) -> DataFrame:
        """The readings as a topic of JSON text, with malformed, blank and overlong texts and null payloads in it."""
        record = F.concat(
            F.lit('{"wind_turbine_id":"'), turbine_key(F.col("user_id")),
            F.lit('","wind_park_id":"'), park_key(F.col("user_id")), F.lit('","current_power":'),
            F.round(F.col("value") * 1000).cast("bigint").cast("string"), F.lit("}"))
        return self._table("events").select(
            F.lit(TOPICS["readings"]).alias("topic"),
            F.pmod("user_id", F.lit(4)).cast("int").alias("partition_id"),
            F.col("event_id").alias("offset_id"), "ts",
            turbine_key(F.col("user_id")).alias("record_key"),
            F.when(F.col("event_id") % 101 == 0, F.lit(None))
            .when(F.col("event_id") % 97 == 0, F.lit("{bad"))
            .when(F.col("event_id") % 89 == 0, F.lit("  "))
            .when(F.col("event_id") % 83 == 0, F.concat(record, F.lit(" xx")))
            .otherwise(record).alias("record_value"))

    def wind_turbines(self) -> DataFrame:
        """Master data for some of the turbines that send readings. Foreign keys are text."""
        return self._table("supplier").select(
            F.col("s_suppkey").cast("int").alias("id"),
            F.col("s_nationkey").cast("string").alias("customer_id"),
            F.pmod("s_suppkey", F.lit(5)).cast("string").alias("wind_park_id"))

    def customers(self) -> DataFrame:
        return self._table("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            (F.lit(100.0) + F.col("n_nationkey") * F.lit(7.5)).alias("price_per_mwh"))

    def wind_parks(self) -> DataFrame:
        return self._table("region").select(F.col("r_regionkey").alias("id"),
                                            F.col("r_name").alias("name"))

    def weather(self) -> DataFrame:
        return self._table("events").select(
            F.col("event_id").alias("offset_id"), "ts", F.col("user_id").cast("int").alias("turbine_id"),
            turbine_key(F.col("user_id")).alias("wind_turbine_id"),
            F.col("value").alias("wind_speed"))

    def turbine_status(self) -> DataFrame:
        return self._table("events").filter(F.col("event_type").isin("error", "signup")).select(
            F.col("event_id").alias("offset_id"), "ts",
            turbine_key(F.col("user_id")).alias("wind_turbine_id"),
            F.col("user_id").cast("int").alias("id"),
            (F.col("event_type") != "error").alias("is_online"),
            F.col("event_type").alias("status"))

    def master_changes(self) -> DataFrame:
        """A changelog of master data: every event renames the turbine's owner, some delete it."""
        return self._table("events").select(
            F.col("event_id").alias("offset_id"), "ts",
            turbine_key(F.col("user_id")).alias("wind_turbine_id"),
            F.col("user_id").cast("int").alias("id"),
            F.concat(F.lit("Customer"), (F.col("event_id") % 25).cast("string")).alias("customer_name"),
            (F.col("event_id") % 13 == 0).alias("is_deleted"))

    def transfers(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("offset_id"),
            F.concat(F.lit("Acct"), (F.col("o_custkey") % 6).cast("string")).alias("sender_account"),
            F.concat(F.lit("Acct"), (F.col("o_orderkey") % 6).cast("string")).alias("receiver_account"),
            (F.floor("o_totalprice") % 1000).cast("int").alias("amount"),
            (F.col("o_orderkey") % 10 < 3).alias("is_suspicious"))

    def keyed_producers(self) -> DataFrame:
        return self._table("events").select(
            F.col("event_id").alias("offset_id"),
            F.when(F.col("user_id") < 5, F.concat(F.lit("HeavyProducer_"),
                                                  F.col("user_id").cast("string")))
            .otherwise(turbine_key(F.col("user_id"))).alias("record_key"))

    def wind_speeds(self) -> DataFrame:
        """Every seventeenth speed is missing."""
        return self._table("events").select(
            F.col("event_id").alias("offset_id"),
            F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("wind_speed"))

    def maintenance(self) -> DataFrame:
        action = (F.when(F.col("event_id") % 3 == 0, "Oil change")
                  .when(F.col("event_id") % 3 == 1, "Blade inspection")
                  .otherwise("Gearbox replacement"))
        return self._table("events").select(
            F.col("event_id").alias("offset_id"), F.col("ts").alias("date"),
            F.col("user_id").cast("int").alias("turbine_id"), action.alias("actions_performed"),
            (F.lit(1000.0) + F.col("value")).alias("maintenance_costs"),
            (F.col("event_id") % 11 + 1).cast("int").alias("months_ahead"))


# The same views for the checking database.
SQL = {
    "readings": """
        SELECT event_id AS offset_id, CAST(user_id % 4 AS INT) AS partition_id, ts,
               concat('Turbine', user_id) AS wind_turbine_id,
               concat('Windpark', user_id % 5) AS wind_park_id,
               round(value * 1000.0::DOUBLE) AS current_power
        FROM events""",
    "late_readings": f"""
        SELECT offset_id, partition_id, wind_turbine_id, wind_park_id, current_power,
               ts - to_seconds((offset_id * 7919) % {JITTER_SECONDS}) AS ts
        FROM readings""",
    "raw_readings": """
        SELECT 'wind-turbine-data' AS topic, CAST(user_id % 4 AS INT) AS partition_id,
               event_id AS offset_id, ts, concat('Turbine', user_id) AS record_key,
               CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0 THEN '{bad'
                    WHEN event_id % 89 = 0 THEN '{bad' WHEN event_id % 83 = 0 THEN '{bad'
                    ELSE concat('{"wind_turbine_id":"Turbine', user_id,
                                '","wind_park_id":"Windpark', user_id % 5,
                                '","current_power":', CAST(round(value * 1000) AS BIGINT), '}')
               END AS record_value
        FROM events""",
    "wind_turbines": """
        SELECT CAST(s_suppkey AS INT) AS id, CAST(s_nationkey AS VARCHAR) AS customer_id,
               CAST(s_suppkey % 5 AS VARCHAR) AS wind_park_id
        FROM supplier""",
    "customers": """
        SELECT n_nationkey AS id, n_name AS name,
               CAST(100.0 + n_nationkey * 7.5 AS DOUBLE) AS price_per_mwh
        FROM nation""",
    "wind_parks": "SELECT r_regionkey AS id, r_name AS name FROM region",
    "master": """
        SELECT t.id, c.name AS customer_name, p.name AS wind_park_name, c.price_per_mwh
        FROM wind_turbines t JOIN customers c ON TRY_CAST(t.customer_id AS INT) = c.id
        JOIN wind_parks p ON TRY_CAST(t.wind_park_id AS INT) = p.id""",
    "weather": """
        SELECT event_id AS offset_id, ts, CAST(user_id AS INT) AS turbine_id,
               concat('Turbine', user_id) AS wind_turbine_id, value AS wind_speed
        FROM events""",
    "turbine_status": """
        SELECT event_id AS offset_id, ts, concat('Turbine', user_id) AS wind_turbine_id,
               CAST(user_id AS INT) AS id, event_type <> 'error' AS is_online, event_type AS status
        FROM events WHERE event_type IN ('error', 'signup')""",
    "master_changes": """
        SELECT event_id AS offset_id, ts, concat('Turbine', user_id) AS wind_turbine_id,
               CAST(user_id AS INT) AS id, concat('Customer', event_id % 25) AS customer_name,
               event_id % 13 = 0 AS is_deleted
        FROM events""",
    "transfers": """
        SELECT o_orderkey AS offset_id, concat('Acct', o_custkey % 6) AS sender_account,
               concat('Acct', o_orderkey % 6) AS receiver_account,
               CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS INT) AS amount,
               o_orderkey % 10 < 3 AS is_suspicious
        FROM orders""",
    "keyed_producers": """
        SELECT event_id AS offset_id,
               CASE WHEN user_id < 5 THEN concat('HeavyProducer_', user_id)
                    ELSE concat('Turbine', user_id) END AS record_key
        FROM events""",
    "wind_speeds": "SELECT event_id AS offset_id, CASE WHEN event_id % 17 <> 0 THEN value END AS wind_speed FROM events",
    "maintenance": """
        SELECT event_id AS offset_id, ts AS date, CAST(user_id AS INT) AS turbine_id,
               CASE event_id % 3 WHEN 0 THEN 'Oil change' WHEN 1 THEN 'Blade inspection'
                    ELSE 'Gearbox replacement' END AS actions_performed,
               1000.0::DOUBLE + value AS maintenance_costs,
               CAST(event_id % 11 + 1 AS INT) AS months_ahead
        FROM events""",
    "outbox": """
        SELECT offset_id, 'WindTurbine' AS aggregatetype, CAST(turbine_id AS VARCHAR) AS aggregateid,
               'MaintenancePerformed' AS type,
               concat('{"turbineId":', turbine_id, ',"action":"', actions_performed,
                      '","nextMaintenance":"',
                      strftime(date + to_months(months_ahead), '%Y-%m-%d %H:%M:%S'), '"}') AS payload,
               md5(concat('WindTurbine|', offset_id)) AS digits
        FROM maintenance""",
    "lines": """
        SELECT offset_id, 'bank-credits' AS topic, sender_account AS key, amount, is_suspicious
        FROM transfers
        UNION ALL
        SELECT offset_id, 'bank-debits', receiver_account, amount, is_suspicious FROM transfers""",
    "timed": """
        SELECT *, max(ts) OVER (PARTITION BY partition_id ORDER BY offset_id
                                ROWS UNBOUNDED PRECEDING) AS stream_time,
               time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
               time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
        FROM late_readings""",
}

# Which views a view is built from.
NEEDS = {"late_readings": ["readings"], "master": ["wind_turbines", "customers", "wind_parks"],
         "outbox": ["maintenance"], "lines": ["transfers"], "timed": ["late_readings"]}


def with_views(query: str, *names: str) -> str:
    """`query` with the named views, and those they need, in front as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + "\n" + query.strip()
