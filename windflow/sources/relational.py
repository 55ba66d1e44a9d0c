"""Relational tables over JDBC, or as files.

The driver jar of the database is the user's. Reads are split by ranges of a numeric column, so
every executor pulls its own share instead of one task pulling the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow import schemas

# The source tables and their schemas.
TABLES: Mapping[str, T.StructType] = {"customers": schemas.CUSTOMERS,
                                      "wind_parks": schemas.WIND_PARKS,
                                      "wind_turbines": schemas.WIND_TURBINES,
                                      "maintenance_logs": schemas.MAINTENANCE,
                                      "debezium_outbox": schemas.OUTBOX_EVENT}


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 bounds: tuple[int, int] | None = None, partitions: int | None = None,
                 fetch_size: int = 10_000, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of `format("jdbc")`.

    `bounds` only says how to cut the ranges; rows outside fall in the first or last range.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)} | dict(properties or {})
    given = [partition_column is not None, bounds is not None, partitions is not None]
    if any(given):
        if not all(given):
            raise ValueError("a split read needs partition_column, bounds and partitions together")
        options |= {"partitionColumn": partition_column, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def read_parquet_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(path)


def newer_than(df: DataFrame, last_seen: int, id_column: str = "id") -> DataFrame:
    """The rows added since `last_seen`: an incremental pull. The filter runs in the database."""
    return df.filter(F.col(id_column) > F.lit(last_seen))
