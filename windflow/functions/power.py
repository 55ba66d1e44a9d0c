"""Power and energy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Watts per unit.
WATTS = {"W": 1.0, "kW": 1e3, "MW": 1e6}

# Cut-in, rated and cut-out wind speed in m/s.
CUT_IN, RATED, CUT_OUT = 3.0, 12.0, 25.0


def convert_power(power: Column, from_unit: str, to_unit: str) -> Column:
    """Rescale between W, kW and MW."""
    source, target = WATTS[from_unit], WATTS[to_unit]
    # Multiply or divide by a whole number, so 1 kW is exactly 1000 W and back.
    if source >= target:
        return power * F.lit(source / target)
    return power / F.lit(target / source)


def clamp(x: Column, low: float | Column, high: float | Column) -> Column:
    """`x` held between the bounds; null stays null."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(x.isNotNull(), F.greatest(low, F.least(high, x)))


def power_curve(wind_speed: Column, max_power: Column) -> Column:
    """Power at a wind speed: nothing outside [cut-in, cut-out), cubic up to the rated speed."""
    share = (wind_speed - CUT_IN) / (RATED - CUT_IN)
    return (F.when((wind_speed < CUT_IN) | (wind_speed >= CUT_OUT), F.lit(0.0))
            .when(wind_speed >= RATED, max_power)
            .otherwise(max_power * F.pow(share, F.lit(3.0))))


def energy_wh(average_watts: Column, hours: float | Column) -> Column:
    return average_watts * (hours if isinstance(hours, Column) else F.lit(hours))


def wh_to_mwh(wh: Column) -> Column:
    return wh / F.lit(1e6)
