"""An upsert that rewrites only the files in which a replaced key lies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import paths
from tripmart.operators.dedupe import latest_per_key
from tripmart.operators.lookup import BROADCAST_ROWS, fits_broadcast
from tripmart.operators.upsert import new_rows
from tripmart.session import scratch_path
from tripmart.sinks.tables import (
    _write_partitions,
    bloom_options,
    check_names,
    current_files,
    load_files,
    load_published,
    partition_columns,
    publish,
    published,
    version_path,
)

# As many keys go into the scan's filter, where Bloom filters rule files and row groups out.
FILTER_KEYS = 1000


@dataclass
class FileUpsert:
    """What an upsert did: files below the table that were replaced, taken over, and new."""

    replaced: list[str]
    kept: list[str]
    added: list[str]


def files_with_keys(
    spark: SparkSession,
    path: str,
    keys: DataFrame,
    key: str,
    fmt: str = "parquet",
    filter_keys: int = FILTER_KEYS,
    max_rows: int = BROADCAST_ROWS,
) -> list[str]:
    """Data files of the published version that hold one of ``keys`` (a column of that name).

    Few keys are a filter of the scan, and files whose Bloom filter knows none of them are not
    read beyond it. More are joined, broadcast if measured small; of the table, only the key column
    is read then.
    """
    table = load_published(spark, path, fmt)
    some = [row[0] for row in keys.select(key).distinct().limit(filter_keys + 1).collect()]
    if len(some) <= filter_keys:
        known = [value for value in some if value is not None]
        here = F.col(key).isin(known) if known else F.lit(False)
        if None in some:
            here = here | F.col(key).isNull()
        held = table.filter(here)
    else:
        wanted = keys.select(F.col(key).alias("_wanted")).distinct()
        wanted = F.broadcast(wanted) if fits_broadcast(wanted, max_rows) else wanted
        held = table.join(wanted, F.col(key).eqNullSafe(F.col("_wanted")), "left_semi")
    found = held.select(F.col("_metadata.file_path").alias("file")).distinct().collect()
    return sorted(paths.below(spark, path, [row.file for row in found]))


def upsert_files(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    version_col: str,
    run_id: str,
    tie_breakers: Sequence[str] = (),
    fmt: str = "parquet",
    filter_keys: int = FILTER_KEYS,
    max_rows: int = BROADCAST_ROWS,
) -> FileUpsert:
    """`upsert_incremental` into the table at ``path``, by file; publishes the new version.

    The rows of ``source`` above the table's mark replace those of their keys. Files in which none
    of these keys lies are in the new version under the names they have. The others are read
    once, without the replaced rows, and written with the new ones, with a Bloom filter of the key.
    Which files a key is in is looked up, not remembered; a table whose files cover ranges of keys,
    or of a time that goes with them, has few of them touched.
    """
    path = path.rstrip("/")
    base = published(spark, path)
    target = load_published(spark, path, fmt)
    check_names(target)
    increment = latest_per_key(new_rows(target, source, version_col), [key], version_col, tie_breakers)
    staged = scratch_path(spark, "increment")
    increment.select(*target.columns).write.format(fmt).save(staged)
    increment = spark.read.schema(target.schema).format(fmt).load(staged)
    listed = current_files(spark, path)
    if not increment.take(1):
        return FileUpsert([], listed, [])

    replaced = files_with_keys(spark, path, increment, key, fmt, filter_keys, max_rows)
    kept = sorted(set(listed) - set(replaced))
    rows = increment
    if replaced:
        keys = increment.select(F.col(key).alias("_wanted")).distinct()
        keys = F.broadcast(keys) if fits_broadcast(keys, max_rows) else keys
        old = load_files(spark, path, replaced, fmt)
        rows = old.join(keys, F.col(key).eqNullSafe(F.col("_wanted")), "left_anti").unionByName(increment)
    folder, by = version_path(path, run_id), partition_columns(spark, path)
    if by:
        _write_partitions(rows.hint("rebalance", *map(F.col, by)), folder, fmt, by, [key])
    else:
        rows.write.mode("overwrite").format(fmt).options(**bloom_options([key])).save(folder)
    added = paths.below(spark, path, spark.read.schema(rows.schema).format(fmt).load(folder).inputFiles())
    publish(spark, path, run_id, base, files=[*kept, *sorted(added)])
    return FileUpsert(replaced, kept, sorted(added))
