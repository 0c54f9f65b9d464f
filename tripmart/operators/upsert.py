"""Incremental upsert above a high-water mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.dedupe import latest_per_key
from tripmart.operators.lookup import BROADCAST_ROWS, fits_broadcast
from tripmart.session import scratch_path

# Fixed value: the mark of an empty target.
FIRST_MARK = "1900-01-01"


def new_rows(target: DataFrame, source: DataFrame, version_col: str) -> DataFrame:
    """Rows of ``source`` strictly above the greatest version in ``target``.

    The mark is a scalar subquery: it is computed once, inside the same plan, and reaches
    the source scan as a pushed filter.
    """
    mark = target.agg(
        F.coalesce(F.max(version_col), F.lit(FIRST_MARK).cast("timestamp")).alias("mark")
    )
    return source.filter(F.col(version_col) > mark.scalar())


def _same_key(key: str, other: str) -> Column:
    # A NULL key is a key like any other, or every run would add it again.
    return F.col(key).eqNullSafe(F.col(other))


def _replaced_keys(
    target: DataFrame, fresh: DataFrame, key: str, max_rows: int
) -> tuple[DataFrame, bool]:
    """Keys of ``target`` that ``fresh`` replaces, and whether they may be broadcast.

    The keys of a small increment serve as they are. A large increment mostly brings keys
    the target does not have; the few it shares with the target are found by a join of the
    key columns alone and kept as a table, so that the wide target need not be shuffled.
    """
    changed = fresh.select(F.col(key).alias("_changed")).distinct()
    if fits_broadcast(changed, max_rows):
        return changed, True
    spark = target.sparkSession
    path = scratch_path(spark, "replaced-keys")
    shared = changed.join(target.select(key), _same_key(key, "_changed"), "left_semi")
    shared.write.parquet(path)
    shared = spark.read.schema(shared.schema).parquet(path)
    return shared, fits_broadcast(shared, max_rows)


def upsert_incremental(
    target: DataFrame,
    source: DataFrame,
    key: str,
    version_col: str,
    tie_breakers: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``target`` with the new rows of ``source``: the newest row per key replaces the old one.

    A row that arrives late with a version equal to the mark is not seen, by definition
    of the mark. Up to ``max_rows`` replaced keys are broadcast and the target is not
    shuffled; beyond that both sides are shuffled on the key.
    """
    fresh = new_rows(target, source, version_col)
    increment = latest_per_key(fresh, [key], version_col, tie_breakers)
    replaced, small = _replaced_keys(target, fresh, key, max_rows)
    if small:
        replaced = F.broadcast(replaced)
    kept = target.join(replaced, _same_key(key, "_changed"), "left_anti")
    return kept.unionByName(increment)


def upsert_partitions(
    target: DataFrame,
    source: DataFrame,
    key: str,
    version_col: str,
    partition: str,
    tie_breakers: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
) -> tuple[DataFrame, list]:
    """The same upsert for a partitioned target: the rows of the partitions it changes, and which.

    Changed are the partitions of the new rows and those that hold a row to be replaced. To find
    the latter, only key and partition of the target are read. The list has one entry for each
    changed partition.
    """
    fresh = new_rows(target, source, version_col)
    increment = latest_per_key(fresh, [key], version_col, tie_breakers)
    replaced, small = _replaced_keys(target, fresh, key, max_rows)
    if small:
        replaced = F.broadcast(replaced)
    held = target.join(replaced, _same_key(key, "_changed"), "left_semi").select(partition)
    touched = [row[0] for row in held.union(increment.select(partition)).distinct().collect()]
    here = F.col(partition).isin([t for t in touched if t is not None])
    if None in touched:
        here = here | F.col(partition).isNull()
    kept = target.filter(here).join(replaced, _same_key(key, "_changed"), "left_anti")
    return kept.unionByName(increment), touched


def merge_increment(increment: DataFrame, table: str, key: str) -> None:
    """The same upsert as a MERGE into a catalog table whose format supports it.

    Such a table rewrites only the files that hold changed keys. Not covered by the tests:
    it needs a table format that is not part of Spark.
    """
    (
        increment.alias("fresh")
        .mergeInto(table, F.expr(f"{table}.{key} <=> fresh.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
