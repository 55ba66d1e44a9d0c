"""Maintenance log rows and the events published with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windflow.functions.text import add_months, stable_uuid, time_text, valid_json
from windflow.operators.routing import require

# Fixed values of the event records.
AGGREGATE_TYPE, EVENT_TYPE = "WindTurbine", "MaintenancePerformed"


def maintenance_log(work: DataFrame, performed_at: Column | None = None) -> DataFrame:
    """Log rows for work reports `turbine_id, actions_performed, maintenance_costs, months_ahead`.

    `date` is `performed_at` (the report's own `date`, else the current time); the next date lies
    `months_ahead` later, at the same time of day, and is the one the event carries too.
    """
    if performed_at is None:
        performed_at = F.col("date") if "date" in work.columns else F.current_timestamp()
    remarks = F.col("remarks") if "remarks" in work.columns else F.lit(None).cast("string")
    rest = [c for c in work.columns if c not in (
        "turbine_id", "date", "actions_performed", "maintenance_costs", "remarks", "months_ahead")]
    return work.select(
        *rest, F.col("turbine_id").cast("int").alias("turbine_id"), performed_at.alias("date"),
        "actions_performed",
        add_months(performed_at, F.col("months_ahead")).alias("next_maintenance_date"),
        F.col("maintenance_costs").cast("double").alias("maintenance_costs"),
        remarks.alias("remarks"))


def outbox_events(log: DataFrame, identity: list[str]) -> DataFrame:
    """One event per log row; `identity` names the columns that tell log rows apart.

    The event id follows from them, so publishing a row again gives the same event.
    """
    payload = F.to_json(F.struct(
        F.col("turbine_id").alias("turbineId"), F.col("actions_performed").alias("action"),
        time_text(F.col("next_maintenance_date")).alias("nextMaintenance")))
    return log.select(
        *identity,
        F.lit(AGGREGATE_TYPE).alias("aggregatetype"),
        F.col("turbine_id").cast("string").alias("aggregateid"),
        F.lit(EVENT_TYPE).alias("type"),
        payload.alias("payload"),
        stable_uuid(F.lit(AGGREGATE_TYPE), *[F.col(c) for c in identity]).alias("payloadid"))


def require_outbox_rows(events: DataFrame) -> DataFrame:
    """The events, failing the batch on one without an id or with a payload that is not JSON."""
    checked = require(events, F.col("payloadid").isNotNull(), "event without an id")
    return require(checked, valid_json(F.col("payload")), "event payload is not JSON")


def split_events(events: DataFrame) -> DataFrame:
    """The events with `is_valid`: false sends an event with a bad payload to the reject output."""
    return events.withColumn("is_valid", valid_json(F.col("payload")))
