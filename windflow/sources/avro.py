"""Avro records with a schema registry's five-byte header.

Decoding needs the separate `org.apache.spark:spark-avro` jar, absent where this repository is
tested: the header handling is tested, the two functions of that jar are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.schemas import avro_schema

# The header is one zero byte and the schema's id as four bytes, highest first.
HEADER_BYTES = 5


def has_header(value: Column) -> Column:
    return (F.octet_length(value) >= HEADER_BYTES) & (F.hex(F.substring(value, 1, 1)) == "00")


def schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")


def payload(value: Column) -> Column:
    return F.substring(value, F.lit(HEADER_BYTES + 1), F.octet_length(value))


def with_header(encoded: Column, registered_id: int) -> Column:
    return F.concat(F.unhex(F.lit(f"00{registered_id:08x}")), encoded)


def decode_avro(df: DataFrame, schema: T.StructType, name: str, value: str = "value",
                required: tuple[str, ...] = ()) -> DataFrame:
    """`df` with `record` decoded from registry-framed Avro bytes; unframed values give null."""
    from pyspark.sql.avro.functions import from_avro

    body = F.when(has_header(F.col(value)), payload(F.col(value)))
    declared = avro_schema(schema, name, required=required)
    return df.withColumn("record", from_avro(body, declared, {"mode": "PERMISSIVE"}))


def encode_avro(df: DataFrame, schema: T.StructType, name: str, registered_id: int,
                required: tuple[str, ...] = ()) -> DataFrame:
    """`df` with `value`: the columns of `schema` as registry-framed Avro bytes."""
    from pyspark.sql.avro.functions import to_avro

    record = F.struct(*[F.col(f.name) for f in schema.fields])
    declared = avro_schema(schema, name, required=required)
    return df.withColumn("value", with_header(to_avro(record, declared), registered_id))
