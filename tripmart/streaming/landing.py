"""Landing a stream in an append-only table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tripmart.functions.frames import decode_frames
from tripmart.functions.lineage import LIVE_SOURCE, add_lineage
from tripmart.functions.registry import ANY_ID, PROBLEM, RAW, decode_by_id
from tripmart.schemas import BRONZE_COLUMNS, TRIP_SCHEMA
from tripmart.sinks.tables import TRANSACTIONAL, append_merge

LIVE = "live"
# The origin that keeps what could not be read.
QUARANTINE = "quarantine"

# Land what has arrived and stop; a scheduled run then ends by itself.
AVAILABLE_NOW = {"availableNow": True}


def land_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    origin: str = LIVE,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to ``origin`` of a table, each input row exactly once.

    Every micro-batch is a batch of the table under its number. The checkpoint repeats a batch
    that was not finished with the same rows, and a finished one is not written again, so a
    restart neither loses nor repeats rows. There is no log of files that would grow with the
    stream; `compact_origin` makes few batches of many.
    """
    if fmt in TRANSACTIONAL:
        writer = df.writeStream.format(fmt).outputMode("append")
    else:
        writer = df.writeStream.foreachBatch(
            lambda batch, number: append_merge(batch, path, origin, str(number), fmt) and None
        )
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW))
    return writer.start(path) if fmt in TRANSACTIONAL else writer.start()


def land_checked(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    origin: str = LIVE,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Land the good rows of `decode_by_id` in ``origin`` and the broken ones in the quarantine.

    A micro-batch is decoded once and written to both origins under its number. A batch that died
    between the two is repeated with the same rows, and the side that is complete stays as it is,
    so each message is on one side exactly once. The quarantine keeps reason, schema id, message
    (bytes, key, and place in the topic) and batch time; a batch without broken rows leaves nothing
    there.
    """
    if fmt in TRANSACTIONAL:
        raise ValueError("a transactional table has no origins to keep broken rows in")
    good_columns = [name for name in df.columns if name not in (PROBLEM, RAW)]

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            good = batch.filter(F.col(PROBLEM).isNull()).select(*good_columns)
            append_merge(good, path, origin, str(number), fmt)
            bad = batch.filter(F.col(PROBLEM).isNotNull())
            if not bad.isEmpty():
                kept = bad.select(
                    F.col(PROBLEM).alias("reason"), "frame_schema_id", f"{RAW}.*",
                    F.current_timestamp().alias("_ingest_ts"),
                )
                append_merge(kept, path, QUARANTINE, str(number), fmt)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()


def run_bronze_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    codec: str = "json",
    mode: str = "FAILFAST",
    fmt: str = "parquet",
    writers: Mapping[int | None, StructType] | None = None,
) -> StreamingQuery:
    """Decode framed messages, add lineage and land them in bronze.

    With ``mode`` QUARANTINE, broken messages go to a quarantine origin and the others land.
    ``writers`` then has the schemas of the frames' ids (see `decode_by_id`); without it, frames of
    every id are read as trip records.
    """
    if mode == "QUARANTINE" or writers is not None:
        decoded = decode_by_id(messages, writers or {ANY_ID: TRIP_SCHEMA}, codec=codec)
        rows = add_lineage(decoded, LIVE_SOURCE)
        known = [name for name in BRONZE_COLUMNS if name in rows.columns]
        return land_checked(rows.select(*known, "frame_schema_id", PROBLEM, RAW), path, checkpoint, trigger, fmt=fmt)
    rows = add_lineage(decode_frames(messages, codec=codec, mode=mode), LIVE_SOURCE)
    known = [name for name in BRONZE_COLUMNS if name in rows.columns]
    return land_stream(rows.select(*known), path, checkpoint, trigger, fmt=fmt)
