"""Framed stream messages: one zero byte, a four-byte schema id, then the encoded record."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.schemas import TRIP_SCHEMA

# First byte and length of the frame header.
MAGIC_BYTE = "00"
HEADER_BYTES = 5


def avro_schema(schema: StructType = TRIP_SCHEMA, name: str = "Trip") -> str:
    """The Avro schema that matches a flat ``StructType``."""
    types = {"string": "string", "integer": "int", "long": "long", "double": "double"}
    fields = []
    for field in schema:
        avro_type = types[field.dataType.typeName()]
        if field.nullable:
            fields.append({"name": field.name, "type": ["null", avro_type], "default": None})
        else:
            fields.append({"name": field.name, "type": avro_type})
    return json.dumps({"type": "record", "name": name, "fields": fields})


def frame_rows(
    df: DataFrame,
    key: str,
    schema_id: int = 1,
    codec: str = "json",
    writers: Mapping[int, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Rows as ``(key, value)`` messages, ready for a Kafka sink.

    ``writers`` has, by schema id, which rows are a writer's and the record it makes of them; a row
    goes to the first that takes it, and rows that none takes are left out. The rows are read once,
    however many writers there are. Without it, whole rows are written under ``schema_id``.
    """
    if writers is None:
        writers = {schema_id: (F.lit(True), F.struct(*df.columns))}
    value = F.lit(None).cast("binary")
    for number, (own, record) in reversed(list(writers.items())):
        if codec == "json":
            body = F.encode(F.to_json(record, {"ignoreNullFields": "false"}), "UTF-8")
        elif codec == "avro":
            from pyspark.sql.avro.functions import to_avro

            body = to_avro(record, avro_schema(df.select(record.alias("record")).schema["record"].dataType))
        else:
            raise ValueError(f"unknown codec {codec!r}")
        header = F.unhex(F.lit(f"{MAGIC_BYTE}{number:08X}"))
        value = F.when(own, F.concat(header, body)).otherwise(value)
    taken = reduce(Column.__or__, [F.coalesce(own, F.lit(False)) for own, _ in writers.values()], F.lit(False))
    return df.filter(taken).select(F.encode(F.col(key), "UTF-8").alias("key"), value.alias("value"))


def _decoded(value: Column, schema: StructType, codec: str, mode: str) -> Column:
    body = F.substring(value, HEADER_BYTES + 1, 2**31 - 1)
    if codec == "json":
        return F.from_json(F.decode(body, "UTF-8"), schema, {"mode": mode})
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(body, avro_schema(schema), {"mode": mode})
    raise ValueError(f"unknown codec {codec!r}")


def decode_frames(
    df: DataFrame,
    schema: StructType = TRIP_SCHEMA,
    codec: str = "json",
    mode: str = "FAILFAST",
    header: bool = False,
) -> DataFrame:
    """Messages as rows, with the stream's ``timestamp`` kept as ``kafka_ts``.

    ``header=True`` adds ``frame_magic`` and ``frame_schema_id``. ``mode`` is FAILFAST
    (a broken record fails the query) or PERMISSIVE (its fields are NULL).
    """
    columns = [_decoded(F.col("value"), schema, codec, mode).alias("data")]
    names = ["data.*"]
    if "timestamp" in df.columns:
        columns.append(F.col("timestamp").alias("kafka_ts"))
        names.append("kafka_ts")
    if header:
        hexed = F.hex(F.substring(F.col("value"), 1, HEADER_BYTES))
        columns += [
            F.conv(F.substring(hexed, 1, 2), 16, 10).cast("int").alias("frame_magic"),
            F.conv(F.substring(hexed, 3, 8), 16, 10).cast("long").alias("frame_schema_id"),
        ]
        names += ["frame_magic", "frame_schema_id"]
    return df.select(*columns).select(*names)
