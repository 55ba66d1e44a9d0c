"""The newest reading per turbine as metric text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windflow.functions.text import METRIC_HEADERS, metric_line
from windflow.operators.aggregates import latest_by_key


def metric_lines(readings: DataFrame, key: str = "wind_turbine_id", park: str = "wind_park_id",
                 power: str = "current_power", order: str = "offset") -> DataFrame:
    """One `line` per turbine, from its newest reading."""
    latest = latest_by_key(readings.select(key, park, power, order), key, order)
    return latest.select(key, metric_line(F.col(key), F.col(park), F.col(power)).alias("line"))


def with_headers(lines: DataFrame) -> DataFrame:
    """The lines after the two header lines; sort by `section` to print them."""
    spark = lines.sparkSession
    head = spark.createDataFrame(list(enumerate(METRIC_HEADERS)), "section INT, line STRING")
    return head.unionByName(lines.select(F.lit(len(METRIC_HEADERS)).alias("section"), "line"))


def write_metric_text(lines: DataFrame, path: str) -> None:
    """The page as text files. One line per turbine, so one sorted output is small."""
    with_headers(lines).orderBy("section", "line").select("line").write.mode("overwrite").text(path)
