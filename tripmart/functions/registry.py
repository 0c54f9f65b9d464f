"""Framed messages of several writers: decoding by schema id, and resolution to one reader.

Each writer's schema stands under the id its frames carry. A record is decoded by the schema it
was written with and then resolved to the reader's: fields by name or alias, types widened or cast,
defaults for what the writer did not know.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.frames import HEADER_BYTES, MAGIC_BYTE, avro_schema
from tripmart.functions.widening import as_type
from tripmart.schemas import TRIP_SCHEMA

#: The id under which a schema stands for all ids that have none of their own.
ANY_ID = None

PROBLEM = "_problem"
RAW = "_raw"
_CORRUPT = "_corrupt_record"

# Columns of a message that say where it came from, as a topic has them.
ORIGIN_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value"]

# Numbers a trip has to have are zero where its writer did not know them.
TRIP_DEFAULTS = {
    f.name: 0 for f in TRIP_SCHEMA if not f.nullable and not isinstance(f.dataType, T.StringType)
}
TRIP_ALIASES = {"vendor_id": ["VendorID"], "airport_fee": ["Airport_fee"]}


def write_schemas(spark: SparkSession, schemas: Mapping[int, T.StructType], path: str) -> None:
    """Append schemas under their ids to the table of writer schemas."""
    rows = [(int(k), s.json()) for k, s in schemas.items()]
    spark.createDataFrame(rows, "schema_id long, schema string").coalesce(1).write.mode("append").parquet(path)


def read_schemas(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """The table of writer schemas: one row per id that was ever registered.

    An id stands for one schema for good; two schemas under one id are refused.
    """
    found: dict[int, T.StructType] = {}
    for row in spark.read.schema("schema_id long, schema string").parquet(path).distinct().collect():
        schema = T.StructType.fromJson(json.loads(row.schema))
        if found.setdefault(row.schema_id, schema) != schema:
            raise ValueError(f"schema id {row.schema_id} stands for two schemas")
    return found


def _parsed(body: Column, schema: T.StructType, codec: str) -> Column:
    if codec == "json":
        with_bad = T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        return F.from_json(F.decode(body, "UTF-8"), with_bad, options)
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(body, avro_schema(schema), {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown codec {codec!r}")


def _resolved(
    record: Column,
    writer: T.StructType,
    reader: T.StructType,
    aliases: Mapping[str, Sequence[str]],
    defaults: Mapping[str, object],
) -> Column:
    """``record`` of the writer as a struct of the reader."""
    known = {f.name: f for f in writer}
    fields = []
    for field in reader:
        names = [n for n in (field.name, *aliases.get(field.name, ())) if n in known]
        if not names:
            value = F.lit(None).cast(field.dataType)
        elif isinstance(known[names[0]].dataType, T.StringType):
            # text that does not read as the type is no value
            value = record[names[0]].try_cast(field.dataType)
        else:
            value = as_type(record[names[0]], known[names[0]].dataType, field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        fields.append(value.alias(field.name))
    return F.struct(*fields)


def decode_by_id(
    messages: DataFrame,
    writers: Mapping[int | None, T.StructType],
    reader: T.StructType = TRIP_SCHEMA,
    aliases: Mapping[str, Sequence[str]] = TRIP_ALIASES,
    defaults: Mapping[str, object] = TRIP_DEFAULTS,
    codec: str = "json",
) -> DataFrame:
    """Messages as rows of the reader's schema, broken ones marked and not dropped.

    Adds ``kafka_ts`` (the message's timestamp, if it has one), ``frame_schema_id``, ``_problem``
    and ``_raw``. ``_problem`` is NULL for a good row, or says what is wrong: the frame, an id that
    ``writers`` does not have, a body that does not read as its schema, or the first field that
    must not be NULL (by the reader's schema) and is. ``_raw`` holds the message as it came, offset
    included, of broken rows only. The ids are cases of one projection: nothing moves.

    JSON bodies are decoded in one pass per message, by its writer's schema alone.
    """
    value = F.col("value")
    head = F.hex(F.substring(value, 1, HEADER_BYTES))
    framed = (F.octet_length(value) >= HEADER_BYTES) & (F.substring(head, 1, 2) == MAGIC_BYTE)
    body = F.substring(value, HEADER_BYTES + 1, 2**31 - 1)
    schema_id = F.when(framed, F.conv(F.substring(head, 3, 8), 16, 10).cast("long"))
    origin = [name for name in ORIGIN_COLUMNS if name in messages.columns]
    raw = F.struct(*origin).alias(RAW)
    named = messages.select(raw, schema_id.alias("frame_schema_id"), body.alias("body"))

    # one column per writer; in each row all but one are NULL and cost nothing
    ids = [k for k in writers if k is not ANY_ID]
    this = {k: F.col("frame_schema_id") == F.lit(k) for k in ids}
    if ANY_ID in writers:
        this[ANY_ID] = ~F.coalesce(F.col("frame_schema_id").isin(ids), F.lit(True)) if ids else F.col("frame_schema_id").isNotNull()
    columns = {k: f"by_{i}" for i, k in enumerate(writers)}
    parsed = named.select(
        RAW,
        "frame_schema_id",
        *(F.when(this[k], _parsed(F.col("body"), s, codec)).alias(columns[k]) for k, s in writers.items()),
    )
    data, broken = F.lit(None), F.lit("unknown schema id")
    for k, schema in writers.items():
        record = F.col(columns[k])
        data = F.when(this[k], _resolved(record, schema, reader, aliases, defaults)).otherwise(data)
        bad = record.isNull() if codec != "json" else record.isNull() | record[_CORRUPT].isNotNull()
        broken = F.when(this[k], F.when(bad, "malformed record")).otherwise(broken)
    broken = F.when(F.col("frame_schema_id").isNull(), "no frame").otherwise(broken)
    if not writers:
        data = F.lit(None).cast(reader)
    rows = parsed.select(RAW, "frame_schema_id", broken.alias("broken"), data.alias("data"))

    absent = [
        F.when(F.col(f"data.{f.name}").isNull(), F.lit(f"no value for {f.name}")) for f in reader if not f.nullable
    ]
    problem = F.coalesce("broken", *absent) if absent else F.col("broken")
    stamp = [F.col(f"{RAW}.timestamp").alias("kafka_ts")] if "timestamp" in origin else []
    named = ["data.*", "kafka_ts", "frame_schema_id", PROBLEM] if stamp else ["data.*", "frame_schema_id", PROBLEM]
    marked = rows.select("data", *stamp, "frame_schema_id", problem.alias(PROBLEM), RAW)
    return marked.select(*named, F.when(F.col(PROBLEM).isNotNull(), F.col(RAW)).alias(RAW))

