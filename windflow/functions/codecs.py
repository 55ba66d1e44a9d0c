"""JSON text <-> typed records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT, _RECORD, _END = "_corrupt_record", "record", "end"
_NUMBERS = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType)


def _number(raw: Column, kind: T.DataType) -> Column:
    """Text as a number; a whole number may be written with a decimal point."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return raw.try_cast(kind)
    exact = raw.try_cast("decimal(38,10)")
    return F.coalesce(raw.try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast("decimal(38,0)").try_cast(kind)))


def _mark(text: Column) -> Column:
    return F.xxhash64(text, F.lit(_END)).cast("string")


@dataclass(frozen=True)
class Codec:
    """Decode and encode one record type.

    By default a missing field is null and text that is not such a record is malformed, as is blank text and
    anything behind the record. With `java_defaults` the result is what a Java object mapper gives:
    missing numbers are 0, missing booleans false, numbers written as text are read as numbers, and
    whole numbers may have a decimal point (70.0).
    """

    schema: T.StructType
    java_defaults: bool = False

    def _wire_schema(self) -> T.StructType:
        fields = self.schema.fields
        if self.java_defaults:
            fields = [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, _NUMBERS)
                      else f for f in fields]
        return T.StructType([T.StructField(_RECORD, T.StructType(fields)), T.StructField(_END, T.StringType()),
                             T.StructField(_CORRUPT, T.StringType())])

    def parse(self, text: Column) -> Column:
        """The parsed text; pass it to `record` and `malformed`.

        The text is parsed as a field of an object that goes on with a mark made of the text's own hash.
        Text that ends the object by itself, or holds more than one value, loses the mark.
        """
        whole = F.concat(F.lit(f'{{"{_RECORD}":'), text, F.lit(f',"{_END}":"'), _mark(text), F.lit('"}'))
        parsed = F.from_json(whole, self._wire_schema(), {"columnNameOfCorruptRecord": _CORRUPT})
        return F.struct(parsed[_RECORD].alias(_RECORD),
                        (parsed[_CORRUPT].isNull() & parsed[_END].eqNullSafe(_mark(text))).alias("whole"))

    def _field(self, parsed: Column, f: T.StructField) -> Column:
        raw = parsed.getField(_RECORD).getField(f.name)
        if not self.java_defaults:
            return raw
        if isinstance(f.dataType, _NUMBERS):
            return F.coalesce(_number(raw, f.dataType), F.lit(0).cast(f.dataType))
        if isinstance(f.dataType, T.BooleanType):
            return F.coalesce(raw, F.lit(False))
        return raw

    def record(self, parsed: Column) -> Column:
        return F.struct(*[self._field(parsed, f).alias(f.name) for f in self.schema.fields])

    def malformed(self, parsed: Column) -> Column:
        bad = ~parsed.getField("whole") | parsed.getField(_RECORD).isNull()
        if self.java_defaults:
            for f in self.schema.fields:
                if isinstance(f.dataType, _NUMBERS):
                    raw = parsed.getField(_RECORD).getField(f.name)
                    bad = bad | (raw.isNotNull() & _number(raw, f.dataType).isNull())
        return F.coalesce(bad, F.lit(False))

    def encode(self, *, struct: Column | None = None) -> Column:
        """JSON text of the record's columns, or of `struct`; null fields are left out."""
        record = struct if struct is not None else F.struct(
            *[F.col(f"`{f.name}`") for f in self.schema.fields])
        return F.to_json(record)


def parsed_once(df: DataFrame, struct: Column) -> DataFrame:
    """`df` with the fields of `struct` as columns, computed once per row.

    A parsed struct in a plain projection would be parsed again for every field and filter that
    uses it, since the optimizer moves those below the projection. It does not move them below a
    generator.
    """
    return df.select("*", F.inline(F.array(struct)))


def decode_json(df: DataFrame, codec: Codec, value: str = "value") -> DataFrame:
    """`df` with `record` (the typed struct) and `state` beside the JSON text.

    `state` is `ok`, `rejected` (malformed, blank or followed by other text; `value` is kept for the
    reject output) or `tombstone` (null payload). One pass: filter on `state` to split the outputs.
    """
    text = F.col(value)
    parsed = parsed_once(df, F.struct(codec.parse(text).alias("__parsed")))
    p = F.col("__parsed")
    state = (F.when(text.isNull(), F.lit("tombstone"))
             .when(codec.malformed(p), F.lit("rejected"))
             .otherwise(F.lit("ok")))
    return (parsed.withColumn("state", state)
            .withColumn("record", F.when(F.col("state") == "ok", codec.record(p)))
            .drop("__parsed"))


def decoded(df: DataFrame, codec: Codec, value: str = "value") -> DataFrame:
    """The well-formed records of a stream, their fields as columns beside the log's own."""
    keep = [c for c in df.columns if c != value]
    return (decode_json(df, codec, value).filter(F.col("state") == "ok")
            .select(*[F.col(f"`{c}`") for c in keep], "record.*"))


def rejects(df: DataFrame, codec: Codec, value: str = "value") -> DataFrame:
    """The malformed records, with the text as it came."""
    return decode_json(df, codec, value).filter(F.col("state") == "rejected").drop("record")


def encode_records(df: DataFrame, codec: Codec, topic: str, key: Column | None = None) -> DataFrame:
    """`topic, key, value` rows ready for any topic sink; `key` may be absent."""
    return df.select(F.lit(topic).alias("topic"),
                     (key.cast("string") if key is not None
                      else F.lit(None).cast("string")).alias("key"),
                     codec.encode().alias("value"))
