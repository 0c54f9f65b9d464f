"""Bronze: raw trips as they arrived, from history and from the live stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.casts import to_double, to_int
from tripmart.functions.lineage import HISTORY_SOURCE, add_lineage
from tripmart.schemas import BRONZE_SCHEMA
from tripmart.sinks.tables import TRANSACTIONAL, append_merge, batch_names, pending, read_batches
from tripmart.sources.tables import read_table
from tripmart.sources.trips import read_history
from tripmart.streaming.landing import LIVE, run_bronze_stream

SEED = "seed"


def bronze_union(history: DataFrame, live: DataFrame) -> DataFrame:
    """History and live rows as one table; a column only one side has is NULL in the other."""
    return history.unionByName(live, allowMissingColumns=True)


def _typed(df: DataFrame) -> DataFrame:
    """Known columns in bronze's types, NULL where a value cannot be read; others as they are."""
    changed = {}
    for field in BRONZE_SCHEMA:
        if field.name not in df.columns or df.schema[field.name].dataType == field.dataType:
            continue
        value, source = F.col(field.name), df.schema[field.name].dataType
        if isinstance(field.dataType, T.IntegerType):
            changed[field.name] = to_int(value, source)
        elif isinstance(field.dataType, T.DoubleType):
            changed[field.name] = to_double(value)
        else:
            changed[field.name] = value.cast(field.dataType)
    return df.withColumns(changed)


def read_bronze(
    spark: SparkSession, path: str, fmt: str = "parquet", done: Mapping[str, Sequence[str]] | None = None
) -> DataFrame | None:
    """All raw trips, or ``None`` while there are none.

    The files keep what arrived; here the columns of the trip record get its types, which the
    origins need to stand in one table, and a value that cannot be read is NULL. Columns beyond
    the trip record are there as the files have them. ``done`` names, per origin, batches to leave
    out (see `bronze_batches`); a compacted batch that holds others too is read whole.
    """
    if fmt in TRANSACTIONAL:
        return read_table(spark, path, fmt, missing="none")
    done = done or {}
    folders = {origin: pending(spark, path, origin, done.get(origin, ())) for origin in (SEED, LIVE)}
    parts = [
        read_batches(spark, folders[SEED], fmt=fmt),
        read_batches(spark, folders[LIVE], BRONZE_SCHEMA, fmt),
    ]
    parts = [_typed(part) for part in parts if part is not None]
    if not parts:
        return None
    table = parts[0] if len(parts) == 1 else bronze_union(*parts)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in BRONZE_SCHEMA if f.name not in table.columns}
    known = BRONZE_SCHEMA.fieldNames()
    return table.withColumns(absent).select(*known, *(c for c in table.columns if c not in known))


def bronze_batches(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Names of the complete batches of each origin."""
    return {origin: batch_names(spark, path, origin) for origin in (SEED, LIVE)}


def run_bronze(
    spark: SparkSession,
    path: str,
    history_path: str | None = None,
    stream: DataFrame | None = None,
    checkpoint: str | None = None,
    ingest_ts: Column | datetime | None = None,
    trigger: dict | None = None,
    fmt: str = "parquet",
    seed_batch: str = "0",
) -> DataFrame | None:
    """Seed bronze from history (if a path is given), then land the stream (if one is given).

    Both may be repeated: the stream goes on from its checkpoint, and a seed batch that is
    complete is left alone, ingest times included; give another ``seed_batch`` for another
    file. (A transactional format appends the seed again; silver drops the copies.) By default
    the stream lands what is there and stops.
    """
    history = read_history(spark, history_path)
    if history is not None:
        append_merge(add_lineage(history, HISTORY_SOURCE, ingest_ts), path, SEED, seed_batch, fmt)
    if stream is not None:
        if checkpoint is None:
            raise ValueError("a stream needs a checkpoint path")
        run_bronze_stream(stream, path, checkpoint, trigger, fmt=fmt).awaitTermination()
    return read_bronze(spark, path, fmt)
