"""Records read by the schema they were written with, and handed on in the reader's."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windflow.functions.codecs import Codec
from windflow.schemas import promotes
from windflow.sources.avro import with_header

Defaults = Mapping[str, object]


def resolved(record: Column, writer: T.StructType, reader: T.StructType, defaults: Defaults | None = None,
             path: str = "") -> Column:
    """`record`, a struct of `writer`, as a struct of `reader`.

    Fields are matched by name. A field that only the writer has goes, one that only the reader has becomes its
    default (`defaults`, by dotted path), else null, or an error if it is required. Numbers may become wider
    (int, long, float, double), text and bytes may be exchanged; other changes of type are errors. A null record
    stays null. Errors are raised here, before anything is read.
    """
    defaults = defaults or {}
    written = {f.name: f for f in writer.fields}

    def field(f: T.StructField) -> Column:
        name = f"{path}{f.name}"
        if f.name not in written:
            if name not in defaults and not f.nullable:
                raise ValueError(f"field {name} is required, is not in the writer's schema and has no default")
            return F.lit(defaults.get(name)).cast(f.dataType)
        before, value = written[f.name], record.getField(f.name)
        if isinstance(before.dataType, T.StructType) and isinstance(f.dataType, T.StructType):
            return resolved(value, before.dataType, f.dataType, defaults, f"{name}.")
        if not promotes(before.dataType, f.dataType):
            raise ValueError(f"field {name} cannot be read as {f.dataType.simpleString()}: "
                             f"it was written as {before.dataType.simpleString()}")
        return value.cast(f.dataType)

    return F.when(record.isNotNull(), F.struct(*[field(f).alias(f.name) for f in reader.fields]))


def by_writer(value: Column, schema_id: Column, writers: Mapping[int, T.StructType], reader: T.StructType,
              defaults: Defaults | None = None,
              parse: Callable[[Column, T.StructType], Column] | None = None) -> Column:
    """`value` decoded by the schema with its `schema_id`, as a struct of `reader`; null for unknown ids and
    values that cannot be read. `parse` decodes a value by a schema; by default it is JSON text."""
    parse = parse or (lambda text, schema: F.from_json(text, schema, {"mode": "PERMISSIVE"}))
    found = F.lit(None).cast(reader)
    for number, writer in writers.items():
        found = F.when(schema_id == number, resolved(parse(value, writer), writer, reader, defaults)).otherwise(found)
    return found


def framed_json(codec: Codec, registered_id: int) -> Column:
    """The columns of `codec`'s schema, in its types, as JSON bytes behind the registry's header."""
    typed = F.struct(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in codec.schema.fields])
    return with_header(codec.encode(struct=typed).cast("binary"), registered_id)
