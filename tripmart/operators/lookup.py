"""Joins to tables that are usually, but not always, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup within both limits is broadcast; beyond them the join is shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

FIXED_FIELD_BYTES = 16

# Of a shuffled join: rows of one key that a task takes on. A key with more is salted over as
# many tasks as that makes.
ROWS_PER_TASK = 2_000_000


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(FIXED_FIELD_BYTES * len(df.columns)).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif not isinstance(field.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            size = size + F.octet_length(F.to_json(F.struct(field.name)))
    return size


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure whether a table is small enough to be sent to every executor.

    Reads at most ``max_rows + 1`` rows per task and brings two numbers to the driver.
    """
    measured = (
        df.select(_row_bytes(df).alias("bytes"))
        .limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))
        .first()
    )
    return measured["rows"] <= max_rows and (measured["bytes"] or 0) <= max_bytes


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    salt_by: Sequence[str],
    small: bool | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left outer join of ``df`` to a ``lookup`` that has one row per ``key``.

    A measured small lookup is broadcast. A large one is shuffled. Rows per key are counted
    first, inside the input tasks, and keys with more than ``rows_per_task`` rows are spread by a
    hash of ``salt_by`` over as many tasks as their count calls for; only their lookup rows are
    copied. All other keys, NULL apart, meet their row in one task each. Pass ``small`` to reuse a
    measurement.
    """
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return df.join(F.broadcast(lookup), key, "left")
    hot = (
        df.groupBy(key)
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_task)).cast("int").alias("_salts"))
        .filter(F.col("_salts") > 1)
        .filter(F.col(key).isNotNull())
    )
    # at most one key for each ``rows_per_task`` rows
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    copies = lookup.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    salt = F.pmod(F.xxhash64(*salt_by), F.coalesce(F.col("_salts"), F.lit(1))).cast("int")
    # a NULL key finds nothing, so its rows need not meet
    salt = F.when(F.col(key).isNull(), F.hash(*salt_by)).otherwise(salt)
    salted = df.join(hot, key, "left").withColumn("_salt", salt)
    return salted.drop("_salts").join(copies.drop("_salts"), [key, "_salt"], "left").drop("_salt")
