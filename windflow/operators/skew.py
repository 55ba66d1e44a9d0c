"""Joins with hot keys.

Inner equi joins are left to Spark first: it broadcasts a side only below
`spark.sql.autoBroadcastJoinThreshold`, and adaptive execution splits a skewed partition of a
sort-merge join. `join_salted` is the explicit form for when one key is known to be hot and
statistics cannot be trusted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# The longest list of hot keys that may be broadcast.
MOST_HOT_KEYS = 100_000


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """The keys that hold more than `share` of all rows with a key: fewer than 1 / share of them.

    Counts are combined on the map side, and only the hot keys come to the driver.
    """
    if not 1 / MOST_HOT_KEYS <= share <= 1:
        raise ValueError(f"share must be in [{1 / MOST_HOT_KEYS}, 1]")
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg((F.sum("__n") * F.lit(share)).alias("__limit"))
    return [row[key] for row in counts.filter(F.col("__n") > total.scalar()).select(key).collect()]


def join_salted(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int = 64,
                share: float = 0.01) -> DataFrame:
    """`left.join(right, key)`, the left rows of hot keys spread over `salts` tasks (batch).

    `spread` is a left column with many values (the offset). Only the right rows of hot keys are
    copied. The hot keys, fewer than 1 / share, are found before the join is planned.
    """
    hot = F.col(key).isin(hot_keys(left, key, share))
    salted_left = left.withColumn("__salt", F.when(hot, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("__salt", F.explode(copies))
    return salted_left.join(salted_right, [key, "__salt"]).drop("__salt")
