"""Change-capture envelopes: `op`, `before`, `after`, with or without an outer `payload`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.functions.codecs import parsed_once
from windflow.schemas import OUTBOX_EVENT

# Fixed values: `c` is an insert, `r` a row that was there when capturing began.
INSERTS = ("c", "r")


def _envelope(row: T.StructType) -> T.StructType:
    inner = [T.StructField("op", T.StringType()), T.StructField("before", row),
             T.StructField("after", row)]
    return T.StructType([*inner, T.StructField("payload", T.StructType(inner))])


def decode_changes(df: DataFrame, row: T.StructType = OUTBOX_EVENT, value: str = "value",
                   ops: tuple[str, ...] = INSERTS) -> DataFrame:
    """The rows inserted according to the change records; other operations give nothing."""
    keep = [c for c in df.columns if c != value]
    change = parsed_once(df, F.struct(F.from_json(value, _envelope(row)).alias("__e")))
    op = F.coalesce("__e.op", "__e.payload.op")
    after = F.coalesce("__e.after", "__e.payload.after")
    return (change.filter(op.isin(*ops) & after.isNotNull())
            .select(*keep, after.alias("__row")).select(*keep, "__row.*"))
