"""Dropping repeated events of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_dedupe(df: DataFrame, keys: Sequence[str], event_col: str, delay: str) -> DataFrame:
    """First row per key among rows whose event times lie within ``delay`` of each other.

    State holds one entry per key and is dropped as the watermark passes, so it is bounded
    by the keys seen within ``delay``. Rows that arrive later than the watermark (the greatest
    event time so far less ``delay``) are dropped, repeated or not. Where they must be kept, land
    the stream as it is and take `latest_per_key` of the table. The first row wins here; for the newest row use
    `latest_per_key` on the landed table.
    """
    timed = df.withColumn(event_col, F.col(event_col).cast("timestamp"))
    return timed.withWatermark(event_col, delay).dropDuplicatesWithinWatermark(list(keys))
