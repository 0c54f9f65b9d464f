"""Checks of a partitioned table from states that are kept beside it.

Every check is a number per date partition that can be put together: counts, a minimum, a maximum.
A keyed check whose key tells the partition counts its repeats inside the partition. For other keys
the state is the number of rows per key and partition, dealt over buckets of the key's hash, with the
repeats of each bucket. A refresh reads the partitions that were touched, replaces their numbers and
the buckets of their keys, and leaves all other files alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.checks import _KEYED, Check, _bad_rows, _decide, _known_rows, _measure, _merged, _present, _row
from tripmart.schemas import PICKUP_DATE
from tripmart.sinks.tables import (
    load_partitions,
    load_published,
    load_written,
    notes_of,
    overwrite,
    publish,
    published,
    replace_partitions,
    version_path,
)

BUCKET = "bucket"

# Buckets of a key that is spread over partitions.
KEY_BUCKETS = 256


@dataclass
class CheckedVersion:
    """A report, and states that are written and not yet published."""

    report: DataFrame
    publications: list[Callable[[], None]] = field(default_factory=list)

    def publish(self) -> None:
        for publication in self.publications:
            publication()


def _split(df: DataFrame, suite: Sequence[Check], determines: Sequence[str]):
    """Checks of columns, keyed ones inside a partition, and keyed ones across partitions."""
    keyed = [c for c in suite if c.kind in _KEYED and _present(df, c)]
    plain = [c for c in suite if c not in keyed]
    local = [c for c in keyed if set(c.columns) & set(determines)]
    return plain, local, [c for c in keyed if c not in local]


def _partition_numbers(
    df: DataFrame, plain: Sequence[Check], local: Sequence[Check], partition: str
) -> DataFrame:
    """One row per partition: its rows, a measure per column check, repeats per local key."""
    measures = {"rows": F.count(F.lit(1))}
    for i, check in enumerate(plain):
        if _present(df, check):
            measures[f"m{i}"] = _measure(check)
    numbers = df.groupBy(partition).agg(*(value.alias(name) for name, value in measures.items()))
    for k, check in enumerate(local):
        counted = df.groupBy(partition, *check.columns).agg(F.count(F.lit(1)).alias("_n"))
        repeats = counted.groupBy(F.col(partition).alias("_p")).agg(
            F.sum(_bad_rows(check, "_n")).alias(f"b{k}"), F.sum(_known_rows(check, "_n")).alias(f"k{k}")
        )
        numbers = numbers.join(repeats, F.col(partition).eqNullSafe(F.col("_p")), "left").drop("_p")
    return numbers


def _key_counts(df: DataFrame, check: Check, partition: str, buckets: int) -> DataFrame:
    """Rows per key and partition, with the bucket of the key."""
    names = [f"key{i}" for i in range(len(check.columns))]
    keys = [F.col(c).alias(n) for c, n in zip(check.columns, names, strict=True)]
    counted = df.groupBy(F.col(partition).cast("string").alias("part"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn(BUCKET, F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int"))


def _bucket_numbers(counts: DataFrame, check: Check) -> DataFrame:
    """Repeats of each bucket, over all partitions."""
    names = [f"key{i}" for i in range(len(check.columns))]
    whole = counts.groupBy(BUCKET, *names).agg(F.sum("n").alias("_n"))
    named = Check(check.kind, names)
    return whole.groupBy(BUCKET).agg(
        F.sum(_bad_rows(named, "_n")).alias("bad"), F.sum(_known_rows(named, "_n")).alias("known")
    )


def _in(column: str, values: Sequence[object]) -> Column:
    """Whether a text column is one of the values, NULL included."""
    here = F.coalesce(F.col(column).isin([str(v) for v in values if v is not None]), F.lit(False))
    return here | F.col(column).isNull() if None in values else here


def refresh_checks(
    spark: SparkSession,
    suite: Sequence[Check],
    path: str,
    states: str,
    run_id: str,
    version: str | None = None,
    parts: dict[str, str] | None = None,
    touched: Sequence[object] | None = None,
    follows: str | None = None,
    partition: str = PICKUP_DATE,
    determines: Sequence[str] = ("tpep_pickup_datetime",),
    fmt: str = "parquet",
    buckets: int = KEY_BUCKETS,
) -> CheckedVersion:
    """Report on a version of the table at ``path``, by the states at ``states``.

    The version is ``version`` with ``parts`` (None: all of its directory), published or not;
    ``touched`` are the partitions in which it differs from the version ``follows``. If the states
    stand at ``follows``, only these are read, else all are. Nothing is published before `publish`
    of the result is called: a gate looks at the report first. The report is that of `evaluate` over
    the whole table. ``determines`` names columns of which each one tells the partition.
    """
    states = states.rstrip("/")
    version = version or published(spark, path)
    place = f"{states}/partitions"
    about = {"suite": json.dumps([[c.kind, c.columns, c.limits] for c in suite], default=str), "of": version}
    notes, base = notes_of(spark, place), published(spark, place)
    known = base is not None and touched is not None and notes.get("suite") == about["suite"]
    known = known and notes.get("of") == follows

    def whole() -> DataFrame:
        if parts is not None:
            return load_written(spark, path, version, parts, fmt)
        return spark.read.format(fmt).load(version_path(path, version))

    table = whole()
    rows = table
    if known:
        some = load_partitions(spark, path, partition, touched, fmt, parts, version) if touched else None
        rows = table.limit(0) if some is None else some
    plain, local, across = _split(table, suite, determines)
    result = CheckedVersion(table)

    numbers = _partition_numbers(rows, plain, local, partition)
    numbers = numbers.withColumn(partition, F.col(partition).cast("string"))
    if known:
        kept = load_published(spark, place, fmt).filter(~_in(partition, touched))
        numbers = numbers.unionByName(kept)
    # one row per partition: a small table, written whole
    written = overwrite(numbers.coalesce(1), place, run_id, fmt, publish_now=False)
    result.publications.append(lambda: publish(spark, place, run_id, base, notes=about))
    kinds = {"rows": "row_count"} | {f"m{i}": c.kind for i, c in enumerate(plain) if f"m{i}" in numbers.columns}
    kinds |= {f"{x}{k}": "unique" for k in range(len(local)) for x in "bk"}
    measured = spark.read.schema(numbers.schema).format(fmt).load(written).agg(
        *(_merged(kind, name) for name, kind in kinds.items())
    )

    for k, check in enumerate(across):
        found = _refresh_keys(spark, check, f"{states}/keys{k}", run_id, rows, touched if known else None, partition, buckets, fmt)
        bad, all_ = found.numbers
        measured = measured.withColumns({f"ab{k}": F.lit(bad), f"ak{k}": F.lit(all_)})
        result.publications += found.publications
    results = [
        _decide(c, table, F.col("rows"), F.col(f"m{i}") if f"m{i}" in kinds else F.lit(None)) for i, c in enumerate(plain)
    ]
    for checks, b, n in ((local, "b", "k"), (across, "ab", "ak")):
        results += [
            _row(c, F.col(f"{n}{k}"), F.col(f"{b}{k}"), F.lit(None), F.col(f"{b}{k}") == 0) for k, c in enumerate(checks)
        ]
    result.report = measured.select(F.inline(F.array(*results)))
    return result


@dataclass
class _Keys:
    numbers: tuple[int, int]
    publications: list[Callable[[], None]]


def _refresh_keys(
    spark: SparkSession,
    check: Check,
    states: str,
    run_id: str,
    rows: DataFrame,
    touched: Sequence[object] | None,
    partition: str,
    buckets: int,
    fmt: str,
) -> _Keys:
    """Repeats of a key over all partitions: (what the check counts, rows or keys it is about)."""
    counts, results = f"{states}/counts", f"{states}/buckets"
    base, base_results = published(spark, counts), published(spark, results)
    fresh = _key_counts(rows, check, partition, buckets)
    if touched is None or base is None or base_results is None:
        written = overwrite(fresh, counts, run_id, fmt, [BUCKET], publish_now=False)
        numbers = _bucket_numbers(spark.read.schema(fresh.schema).format(fmt).load(written), check)
        done = [lambda: publish(spark, counts, run_id, base)]
    else:
        # buckets of keys that were or are in a touched partition
        before = load_published(spark, counts, fmt)
        gone = before.filter(_in("part", touched)).select(BUCKET)
        changed = [row[0] for row in gone.union(fresh.select(BUCKET)).distinct().collect()]
        numbers = load_published(spark, results, fmt)
        done = []
        if changed:
            held = load_partitions(spark, counts, BUCKET, changed, fmt)
            kept = fresh if held is None else held.filter(~_in("part", touched)).unionByName(fresh)
            # files in order of partition let the next refresh skip row groups
            kept = kept.repartition(BUCKET).sortWithinPartitions(BUCKET, "part")
            parts = replace_partitions(kept, counts, run_id, BUCKET, changed, fmt, publish_now=False)
            done = [lambda: publish(spark, counts, run_id, base, parts)]
            now = load_partitions(spark, counts, BUCKET, changed, fmt, parts, run_id)
            numbers = numbers.filter(~F.col(BUCKET).isin(changed))
            if now is not None:
                numbers = numbers.unionByName(_bucket_numbers(now, check))
    written = overwrite(numbers.coalesce(1), results, run_id, fmt, publish_now=False)
    total = spark.read.schema(numbers.schema).format(fmt).load(written).agg(F.sum("bad"), F.sum("known")).first()
    done.append(lambda: publish(spark, results, run_id, base_results))
    return _Keys((total[0] or 0, total[1] or 0), done)
