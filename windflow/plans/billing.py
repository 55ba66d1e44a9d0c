"""What each customer owes: energy per window, times the customer's price.

In whole numbers and decimals, so that the result depends neither on the order of adding nor on the
engine: the energy of a window is rounded once, to a millionth of a watt hour, and sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windflow.functions.durations import micros
from windflow.functions.text import turbine_key
from windflow.operators.joins import join_master_data
from windflow.operators.windows import windowed_average

# Megawatt hours in a millionth of a watt hour; multiplying by it is exact.
_MWH = "CAST(0.000000000001 AS DECIMAL(12,12))"


def window_energy(averages: DataFrame, size: str) -> DataFrame:
    """Adds `energy_uwh`, the mean power times the window's length; halves are rounded up."""
    hour = micros("1 hour")
    micro_watts = "CAST(CAST(sum_power AS DECIMAL(20,6)) * 1000000 AS DECIMAL(24,0))"
    top, low = f"{micro_watts} * {micros(size)}", f"CAST(num_data_points AS DECIMAL(11,0)) * {hour}"
    return averages.withColumn("energy_uwh", F.expr(f"(2 * {top} + {low}) DIV (2 * {low})"))


def customer_charge(readings: DataFrame, turbines: DataFrame, customers: DataFrame,
                    parks: DataFrame, ts: str = "timestamp", size: str = "1 minute") -> DataFrame:
    """`customer_name`, `energy_mwh` and `charge` as decimals.

    Energy is summed per turbine before the join, so the join sees one row per turbine.
    """
    windows = window_energy(windowed_average(readings, "wind_turbine_id", ts, "current_power", size), size)
    per_turbine = windows.groupBy("wind_turbine_id").agg(
        F.sum(F.col("energy_uwh").cast("decimal(20,0)")).alias("energy_uwh"))
    master = join_master_data(turbines, customers, parks).select(
        turbine_key(F.col("id")).alias("wind_turbine_id"), "customer_name", "price_per_mwh")
    priced = per_turbine.join(master, "wind_turbine_id").withColumn(
        "cost", F.col("energy_uwh").cast("decimal(24,0)") * F.col("price_per_mwh").cast("decimal(12,4)"))
    return priced.groupBy("customer_name").agg(
        F.sum("energy_uwh").alias("__uwh"), F.sum("cost").alias("__cost")).select(
        "customer_name",
        F.expr(f"CAST(__uwh AS DECIMAL(24,0)) * {_MWH}").alias("energy_mwh"),
        F.expr(f"CAST(__cost AS DECIMAL(26,4)) * {_MWH}").alias("charge"))
