"""Record schemas, field naming and schema evolution."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"STRING": T.StringType(), "DOUBLE": T.DoubleType(), "INT": T.IntegerType(),
          "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType()}


def struct_of(columns: str) -> T.StructType:
    """`"id INT, name STRING"` as a schema. `StructType.fromDDL` needs a running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Field names and types of the records on the wire.
READING = struct_of("wind_turbine_id STRING, wind_park_id STRING, current_power DOUBLE")
READING_V2 = struct_of(
    "wind_turbine_id STRING, wind_park_id STRING, current_power DOUBLE, manufacturer STRING")
RUNNING_AVERAGE = struct_of("sum_power DOUBLE, num_data_points BIGINT, average DOUBLE")
MASTER_DATA = struct_of("id INT, customer_name STRING, wind_park_name STRING")
STATUS = struct_of("id INT, is_online BOOLEAN, status STRING")
WEATHER = struct_of("turbine_id INT, temperature DOUBLE, humidity DOUBLE, wind_speed DOUBLE, "
               "wind_direction STRING, air_pressure DOUBLE")
ENERGY = struct_of("wind_turbine_id STRING, generated_power_in_mwh DOUBLE")
TRANSFER = struct_of("sender_account STRING, receiver_account STRING, amount INT, is_suspicious BOOLEAN")
CUSTOMERS = struct_of("id INT, name STRING, price_per_mwh DOUBLE")
WIND_PARKS = struct_of("id INT, name STRING")
WIND_TURBINES = struct_of("id INT, customer_id STRING, wind_park_id STRING")
MAINTENANCE = struct_of("turbine_id INT, date TIMESTAMP, actions_performed STRING, "
                   "next_maintenance_date TIMESTAMP, maintenance_costs DOUBLE, remarks STRING")
OUTBOX_EVENT = struct_of("aggregatetype STRING, aggregateid STRING, type STRING, payload STRING, "
                    "payloadid STRING")
TOPIC_LOG = struct_of("topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, "
                 "key STRING, value STRING")
LEDGER = struct_of("topic STRING, partition INT, offset BIGINT, key STRING, value STRING, "
                   "txn_state STRING, next_offset BIGINT")

READING_WITH_MASTER_DATA = T.StructType(
    [T.StructField("turbine_data", READING), T.StructField("master_data", MASTER_DATA)])
STATUS_WITH_MASTER_DATA = T.StructType(
    [T.StructField("turbine_status", STATUS), T.StructField("master_data", MASTER_DATA)])
READING_WITH_WEATHER = T.StructType(
    [T.StructField("turbine_data", READING), T.StructField("weather_data", WEATHER)])

# Topic names.
TOPICS = {
    "readings": "wind-turbine-data",
    "readings_avro": "wind-turbine-data-avro",
    "turbine_averages": "wind-turbine-power-sliding-average",
    "park_averages": "wind-park-power-sliding-average",
    "master_data": "wind-turbine-masterdata",
    "status": "wind-turbine-status",
    "weather": "weather-data",
    "readings_with_master_data": "wind-turbine-data-with-wind-park-names",
    "status_with_master_data": "wind-turbine-status-with-masterdata",
    "readings_with_weather": "wind-turbine-data-with-weather-data",
    "energy": "wind-turbine-energy-generated",
    "transfers": "bank-transactions",
    "credits": "bank-credits",
    "debits": "bank-debits",
    "much_wind": "much-wind",
    "little_wind": "little-wind",
    "ping": "ping",
}


def snake_name(name: str) -> str:
    """`windTurbineId` -> `wind_turbine_id`: an underscore before every capital but the first."""
    return "".join("_" + c.lower() if c.isupper() and i else c.lower()
                   for i, c in enumerate(name))


def snake_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(snake_name(f.name), snake_type(f.dataType), f.nullable)
                             for f in dtype.fields])
    return dtype


def snake_case(df: DataFrame) -> DataFrame:
    """Every field, nested ones included, under its lower snake case name."""
    return df.select(*[F.col(f"`{f.name}`").cast(snake_type(f.dataType)).alias(snake_name(f.name))
                       for f in df.schema.fields])


def check_compatible(old: T.StructType, new: T.StructType, level: str = "FULL", promotions: bool = False) -> list[str]:
    """Why `new` may not replace `old`, as a list of messages; empty means it may.

    BACKWARD: readers of `new` understand data written with `old`, so an added field must be
    nullable. FORWARD: the reverse, so a removed field must have been nullable. FULL: both. A
    field present on both sides keeps its type, at every level; with `promotions` it may become one
    that it `promotes` to, in the direction that is read.
    """
    levels = {"NONE": (False, False), "BACKWARD": (True, False),
              "FORWARD": (False, True), "FULL": (True, True)}
    if level not in levels:
        raise ValueError(f"unknown compatibility level {level!r}")
    backward, forward = levels[level]
    if not (backward or forward):
        return []

    def walk(a: T.StructType, b: T.StructType, path: str) -> list[str]:
        before = {f.name: f for f in a.fields}
        after = {f.name: f for f in b.fields}
        found = []
        if backward:
            found += [f"added field {path}{n} has no default"
                      for n, f in after.items() if n not in before and not f.nullable]
        if forward:
            found += [f"removed field {path}{n} had no default"
                      for n, f in before.items() if n not in after and not f.nullable]
        for name in before.keys() & after.keys():
            x, y = before[name], after[name]
            if isinstance(x.dataType, T.StructType) and isinstance(y.dataType, T.StructType):
                found += walk(x.dataType, y.dataType, f"{path}{name}.")
            elif x.dataType != y.dataType and not (
                    promotions and (not backward or promotes(x.dataType, y.dataType))
                    and (not forward or promotes(y.dataType, x.dataType))):
                found.append(f"field {path}{name} changed from {x.dataType.simpleString()} "
                             f"to {y.dataType.simpleString()}")
            if backward and x.nullable and not y.nullable:
                found.append(f"field {path}{name} became required")
            if forward and y.nullable and not x.nullable:
                found.append(f"field {path}{name} became optional")
        return sorted(found)

    return walk(old, new, "")


# What each type may be read as besides itself.
_PROMOTIONS = {T.IntegerType: (T.LongType, T.FloatType, T.DoubleType), T.LongType: (T.FloatType, T.DoubleType),
               T.FloatType: (T.DoubleType,), T.StringType: (T.BinaryType,), T.BinaryType: (T.StringType,)}


def promotes(written: T.DataType, read: T.DataType) -> bool:
    """Whether values written as one type can be read as the other."""
    return written == read or isinstance(read, _PROMOTIONS.get(type(written), ()))


def check_history(versions: Sequence[T.StructType], new: T.StructType, level: str = "FULL_TRANSITIVE") -> list[str]:
    """Why `new` may not follow `versions`, oldest first; empty means it may.

    A level that ends in `_TRANSITIVE` compares with all versions, any other with the last. Wider numbers are
    no change for readers (BACKWARD), narrower ones none for those who still read by an old version (FORWARD).
    """
    plain = level.removesuffix("_TRANSITIVE")
    against = list(enumerate(versions, 1))[0 if plain != level else -1:]
    return [f"version {number}: {message}" for number, old in against
            for message in check_compatible(old, new, plain, promotions=True)]


def read_together(*versions: DataFrame) -> DataFrame:
    """Frames written under several versions of a schema as one; missing fields become null."""
    first, *rest = versions
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


_AVRO_TYPES = {T.StringType: "string", T.DoubleType: "double", T.FloatType: "float",
               T.IntegerType: "int", T.LongType: "long", T.BooleanType: "boolean",
               T.BinaryType: "bytes"}


def avro_schema(schema: T.StructType, name: str, namespace: str = "wind",
                required: tuple[str, ...] = ()) -> str:
    """The Avro record declaration of `schema` as JSON text.

    Nullable fields become `["null", type]` with default null, except the `required` ones.
    """
    def of(dtype: T.DataType, field: str):
        if isinstance(dtype, T.StructType):
            return record(dtype, "".join(p.capitalize() for p in field.split("_")), None)
        if isinstance(dtype, T.TimestampType):
            return {"type": "long", "logicalType": "timestamp-micros"}
        if type(dtype) not in _AVRO_TYPES:
            raise ValueError(f"no Avro type for {field}: {dtype.simpleString()}")
        return _AVRO_TYPES[type(dtype)]

    def record(struct: T.StructType, record_name: str, ns: str | None) -> dict:
        fields = []
        for f in struct.fields:
            if f.nullable and f.name not in required:
                fields.append({"name": f.name, "type": ["null", of(f.dataType, f.name)],
                               "default": None})
            else:
                fields.append({"name": f.name, "type": of(f.dataType, f.name)})
        head = {"namespace": ns} if ns else {}
        return head | {"type": "record", "name": record_name, "fields": fields}

    return json.dumps(record(schema, name, namespace))
