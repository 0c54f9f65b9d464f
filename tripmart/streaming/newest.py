"""The newest row per key of a stream, whatever the order in which rows arrive."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tripmart import paths
from tripmart.operators.dedupe import latest_per_key
from tripmart.sinks.tables import append_merge, batches, compact_origin, read_origins
from tripmart.streaming.landing import AVAILABLE_NOW

NEWEST = "newest"
# The origin of rows that arrive after the watermark has passed them.
LATE = "late"

_MARK = "_watermark"

# Batches that a reader has to put together before they are folded into one.
FOLD_EVERY = 16


def _mark(spark: SparkSession, path: str, number: int) -> int | None:
    """Greatest event time, in microseconds, of all batches before ``number``."""
    place = f"{path}/{_MARK}"
    if not paths.exists(spark, place):
        return None
    kept = json.loads(paths.read_text(spark, place))
    # a batch that is repeated sees what it saw the first time
    return kept["before"] if kept["batch"] >= number else kept["after"]


def keep_newest(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    event_col: str,
    tie_breakers: Sequence[str] = (),
    delay: str | None = None,
    fold_every: int = FOLD_EVERY,
    trigger: dict | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Keep the newest row per key (by ``event_col``, then ``tie_breakers``) as a table.

    Every micro-batch adds its own newest rows, as a batch of the table under its number: the cost
    of a batch follows the batch and not the table, and a repeated batch is known to be in. Every
    ``fold_every`` batches are folded into one, in which replaced rows are gone. There is no state
    in memory, so a key may come back after any time.

    Rows whose event time lies more than ``delay`` before the greatest of all earlier batches go,
    all of them, to the origin `LATE`. They are not lost: `read_newest` takes them in unless told
    otherwise. NULL event times are never late and lose to all others.
    """
    path = path.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _mark(spark, path, number)
        batch = batch.persist()
        try:
            time = F.unix_micros(F.col(event_col).cast("timestamp"))
            in_time = F.lit(True)
            if delay is not None and before is not None:
                bound = F.timestamp_micros(F.lit(before)) - F.expr(f"interval {delay}")
                in_time = F.coalesce(time >= F.unix_micros(bound), F.lit(True))
            newest = latest_per_key(batch.filter(in_time), keys, event_col, tie_breakers)
            append_merge(newest, path, NEWEST, str(number), fmt)
            late = batch.filter(~in_time)
            if not late.isEmpty():
                append_merge(late, path, LATE, str(number), fmt)
            seen = batch.agg(F.max(time)).first()[0]
        finally:
            batch.unpersist()
        after = max((x for x in (before, seen) if x is not None), default=None)
        mark = {"batch": number, "before": before, "after": after}
        paths.replace_text(spark, f"{path}/{_MARK}", json.dumps(mark))
        if len(batches(spark, path, NEWEST)) >= fold_every:
            fold_newest(spark, path, f"{number}", keys, event_col, tie_breakers, fmt)

    writer = df.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()


def fold_newest(
    spark: SparkSession,
    path: str,
    run_id: str,
    keys: Sequence[str],
    event_col: str,
    tie_breakers: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Put the batches in time together, each key's newest row only; the late ones stay apart."""
    compact_origin(
        spark, path, NEWEST, run_id, fmt=fmt,
        reduced=lambda table: latest_per_key(table, keys, event_col, tie_breakers),
    )


def read_newest(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    event_col: str,
    tie_breakers: Sequence[str] = (),
    late: bool = True,
    fmt: str = "parquet",
) -> DataFrame | None:
    """The newest row per key of all that arrived, or (``late`` off) of what arrived in time."""
    rows = read_origins(spark, path, [NEWEST, LATE] if late else [NEWEST], fmt=fmt)
    return None if rows is None else latest_per_key(rows, keys, event_col, tie_breakers)
