"""Lineage columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where a bronze row came from.
HISTORY_SOURCE = "historical_parquet"
LIVE_SOURCE = "kafka_live"


def add_lineage(
    df: DataFrame, source: str, ingest_ts: Column | datetime | None = None
) -> DataFrame:
    """Add ``_ingest_ts`` (now, unless given) and ``record_source``."""
    if ingest_ts is None:
        ingest_ts = F.current_timestamp()
    elif not isinstance(ingest_ts, Column):
        ingest_ts = F.lit(ingest_ts)
    return df.withColumns({"_ingest_ts": ingest_ts, "record_source": F.lit(source)})
