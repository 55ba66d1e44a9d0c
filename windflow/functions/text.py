"""Keys, labels, metric lines and time text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts of labels and metric lines.
TURBINE_PREFIX = "Turbine"
PARK_PREFIX = "Windpark"
PARKS = 5
SUSPICIOUS_SUFFIX = " <-Suspicious!"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
METRIC_HEADERS = ("# HELP power The current power of a wind turbine in W",
                  "# TYPE power counter")


def turbine_key(turbine_id: Column) -> Column:
    return F.concat(F.lit(TURBINE_PREFIX), turbine_id.cast("string"))


def park_key(turbine_id: Column, parks: int = PARKS) -> Column:
    return F.concat(F.lit(PARK_PREFIX), F.pmod(turbine_id, F.lit(parks)).cast("string"))


def amount_label(amount: Column, is_suspicious: Column) -> Column:
    """`70€`, or `5€ <-Suspicious!` for a flagged transfer."""
    return F.concat(amount.cast("string"), F.lit("€"),
                    F.when(is_suspicious, F.lit(SUSPICIOUS_SUFFIX)).otherwise(F.lit("")))


def two_decimals(x: Column) -> Column:
    return F.format_string("%.2f", x)


def metric_line(turbine: Column, park: Column, power: Column) -> Column:
    return F.format_string("power{turbine=%s,windPark=%s} %.2f", turbine, park, power)


def add_months(at: Column, months: Column) -> Column:
    """Later by whole months with the time of day kept; the day is cut to the month's length."""
    return at + F.make_ym_interval(F.lit(0), months)


def time_text(at: Column) -> Column:
    return F.date_format(at, TIME_FORMAT)


def utf8_text(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def utf8_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def stable_uuid(*parts: Column) -> Column:
    """An id in UUID form that depends only on `parts`, so a replay gives the same one."""
    digits = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digits, a, n) for a, n in cuts])


def valid_json(text: Column) -> Column:
    return F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))
