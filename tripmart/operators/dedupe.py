"""Latest row per key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.lookup import BROADCAST_ROWS, fits_broadcast
from tripmart.session import scratch_path

# Of a table laid out by partition: about so many rows of a partition go to one task and file.
ROWS_PER_PART = 1_000_000
# Rows are counted in so many parts of their keys' hash; a part so many times the mean has a hot key.
HASH_PARTS, HOT = 256, 8


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Keep the row with the greatest ``order_col`` per key, then by ``tie_breakers``.

    NULLs lose. ``row_number() = 1`` lets Spark cut every input task down to one row per
    key before the shuffle, so even a key that holds a third of the rows reaches its
    reducer as at most one row per input task.
    """
    order = [F.col(name).desc_nulls_last() for name in (order_col, *tie_breakers)]
    return first_per_key(df, keys, order)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key in ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_row_num", F.row_number().over(window))
        .filter(F.col("_row_num") == 1)
        .drop("_row_num")
    )


def latest_by_partition(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str],
    partition: str,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """`latest_per_key` whose rows also lie by ``partition``, ready to be written by it.

    ``keys`` have to tell the partition, and ``df`` is read twice. One shuffle does for both: a
    partition is dealt by a hash of the keys over as many tasks as its rows, counted first, call
    for. Where one key may fill a task of its own, rows are cut down to one per key inside the
    input tasks and rebalanced afterwards, which is a second shuffle.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(HASH_PARTS)).alias("_part")
    counted = df.groupBy(F.col(partition).alias("_of"), part).agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy("_of").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    if any(r.most > max(rows_per_part, HOT * r.n / HASH_PARTS) for r in sizes):
        return latest_per_key(df, keys, order_col, tie_breakers).hint("rebalance", F.col(partition))
    kind = df.schema[partition].dataType.simpleString()
    dealt = [(r["_of"], math.ceil(r.n / rows_per_part)) for r in sizes if r.n > rows_per_part]
    salts = F.broadcast(df.sparkSession.createDataFrame(dealt, f"_of {kind}, _salts int"))
    salted = df.join(salts, F.col(partition).eqNullSafe(F.col("_of")), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*keys), F.coalesce("_salts", F.lit(1)))
    )
    laid = salted.drop("_of", "_salts").repartition(partition, "_salt")
    order = [F.col(name).desc_nulls_last() for name in (order_col, *tie_breakers)]
    return first_per_key(laid, [partition, "_salt", *keys], order).drop("_salt")


def latest_of_repeated(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame | None:
    """`latest_per_key` of a table in which few keys come more than once: other rows do not move.

    The keys that do are found from the key columns alone, and kept as a table. None if they are
    more than can be broadcast (``max_rows``, measured).
    """
    names = {key: f"_again_{i}" for i, key in enumerate(keys)}
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    again = counted.select(*(F.col(key).alias(name) for key, name in names.items()))
    path = scratch_path(df.sparkSession, "repeated-keys")
    again.write.parquet(path)
    again = df.sparkSession.read.schema(again.schema).parquet(path)
    if not fits_broadcast(again, max_rows):
        return None
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]
    once = df.join(F.broadcast(again), same, "left_anti")
    several = df.join(F.broadcast(again), same, "left_semi")
    return once.unionByName(latest_per_key(several, keys, order_col, tie_breakers))
