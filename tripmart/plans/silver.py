"""Silver: typed, valid, enriched trips, one row per trip and pickup time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.metrics import pickup_partition
from tripmart.operators.clean import trip_metrics, type_trips, valid_trips
from tripmart.operators.dedupe import latest_by_partition, latest_per_key
from tripmart.operators.lookup import BROADCAST_ROWS, fits_broadcast
from tripmart.operators.zones import enrich_zones
from tripmart.plans.bronze import bronze_batches, read_bronze
from tripmart.schemas import (
    BRONZE_COLUMNS,
    BRONZE_SCHEMA,
    PARTITION_UNIT,
    PICKUP_DATE,
    SILVER_COLUMNS,
    SILVER_KEY,
)
from tripmart.sinks.tables import (
    current_parts,
    load_partitions,
    notes_of,
    overwrite,
    publish,
    published,
    replace_partitions,
)

# Rows of one micro-batch share their ingest time. The stream's own time decides next,
# then the remaining columns, so that only equal rows are still tied.
TIE_BREAKERS = ["kafka_ts"] + [
    name
    for name in BRONZE_SCHEMA.fieldNames()
    if name not in (*SILVER_KEY, "kafka_ts", "_ingest_ts")
]

# The silver key, time first: sorting compares the first eight bytes of a row's key before
# anything else, and those tell times apart where ids share a prefix.
SORT_KEY = ["tpep_pickup_datetime", "trip_id"]


def _with_bronze_columns(df: DataFrame) -> DataFrame:
    absent = [f for f in BRONZE_SCHEMA if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


def clean_trips(bronze: DataFrame, tie_breakers: Sequence[str] = tuple(TIE_BREAKERS)) -> DataFrame:
    """Silver without the zones.

    Invalid rows go first, so that a broken newest row does not hide an older valid one,
    and the latest row is taken before anything is added: the shuffle carries only the
    raw columns, and what is derived from them is derived afterwards.
    """
    typed = valid_trips(type_trips(_with_bronze_columns(bronze)))
    return trip_metrics(latest_per_key(typed, SORT_KEY, "_ingest_ts", tie_breakers))


def silver_trips(
    bronze: DataFrame,
    zones: DataFrame,
    tie_breakers: Sequence[str] = tuple(TIE_BREAKERS),
    cell_col: str | None = None,
) -> DataFrame:
    trips = clean_trips(bronze, tie_breakers)
    return enrich_zones(trips, zones, cell_col).select(*SILVER_COLUMNS)


def run_silver(
    bronze: DataFrame,
    zones: DataFrame,
    path: str,
    run_id: str,
    tie_breakers: Sequence[str] = tuple(TIE_BREAKERS),
    fmt: str = "parquet",
    publish_now: bool = True,
    partition_unit: str = PARTITION_UNIT,
) -> str:
    """Recompute silver and write it as a new version, partitioned by pickup date.

    The rows of `silver_trips`: ``bronze`` is read twice, and its raw columns are shuffled once, by
    key and date, before the zones are added. Returns where it was written.
    """
    typed = valid_trips(type_trips(_with_bronze_columns(bronze)))
    date = pickup_partition(F.col("tpep_pickup_datetime"), partition_unit)
    raw = typed.select(*dict.fromkeys((*BRONZE_COLUMNS, *tie_breakers)), date.alias(PICKUP_DATE))
    newest = latest_by_partition(raw, SORT_KEY, "_ingest_ts", tie_breakers, PICKUP_DATE)
    small = fits_broadcast(zones)
    dated = enrich_zones(trip_metrics(newest), zones, small=small).select(*SILVER_COLUMNS, PICKUP_DATE)
    # other than a broadcast, a shuffled join leaves the rows by zone
    return overwrite(dated, path, run_id, fmt, [PICKUP_DATE], publish_now=publish_now, balanced=small)


@dataclass
class SilverChange:
    """A version of silver that is written, and what a publication of it needs.

    ``touched`` are the date partitions that differ from the version ``base``; None means all.
    ``parts`` is None where the version holds every partition itself.
    """

    base: str | None
    run_id: str
    touched: list | None
    parts: dict[str, str] | None
    notes: dict = field(default_factory=dict)

    def publish(self, spark: SparkSession, path: str) -> None:
        """Publish it; the notes keep what was touched, for those who follow this table."""
        if self.run_id != self.base:
            touched = None if self.touched is None else [str(value) for value in self.touched]
            notes = self.notes | {"touched": touched, "follows": self.base}
            publish(spark, path, self.run_id, self.base, self.parts, notes)


def _zones_digest(zones: DataFrame) -> str:
    named = sorted(zones.columns)
    row = zones.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64(*named)), F.lit(0))).first()
    return f"{row[0]}:{row[1]}"


def refresh_silver(
    spark: SparkSession,
    bronze_path: str,
    zones: DataFrame,
    path: str,
    run_id: str,
    tie_breakers: Sequence[str] = tuple(TIE_BREAKERS),
    fmt: str = "parquet",
    partition_unit: str = PARTITION_UNIT,
    max_rows: int = BROADCAST_ROWS,
) -> SilverChange | None:
    """Silver with the bronze batches that came since its published version; not published yet.

    Equal to `run_silver` over all of bronze, since the latest of a key's rows is the latest of
    those seen so far and the new ones. So only date partitions that hold a new row are read and
    written; in them, the rows of other keys stay as they are and are not shuffled by key if the
    new keys are few enough to broadcast (``max_rows``, measured). A trip whose pickup time is
    corrected is a new row beside the old one, as it is in silver made in one go, and touches the
    new date only. A batch may be applied again without harm, so a run that died is repeated.

    ``tie_breakers`` have to be columns of silver. The version's notes name the batches in it and
    a digest of the zones. Other zones, other partitions or a first run mean all of silver. Returns
    None while bronze is empty.
    """
    base, notes = published(spark, path), notes_of(spark, path)
    arrived = bronze_batches(spark, bronze_path)
    new_notes = {"bronze": arrived, "zones": _zones_digest(zones), "unit": partition_unit}
    same = all(notes.get(k) == new_notes[k] for k in ("zones", "unit"))
    if base is None or not same or "bronze" not in notes:
        bronze = read_bronze(spark, bronze_path, fmt)
        if bronze is None:
            return None
        run_silver(bronze, zones, path, run_id, tie_breakers, fmt, False, partition_unit)
        return SilverChange(base, run_id, None, None, new_notes)

    fresh = read_bronze(spark, bronze_path, fmt, done=notes["bronze"])
    if fresh is None:
        return SilverChange(base, base, [], current_parts(spark, path), notes)
    # the files of the new batches are read for their dates, for their keys and for their rows
    valid = valid_trips(type_trips(_with_bronze_columns(fresh))).select(*BRONZE_COLUMNS)
    valid = valid.withColumn(PICKUP_DATE, pickup_partition(F.col("tpep_pickup_datetime"), partition_unit))
    touched = [row[0] for row in valid.select(PICKUP_DATE).distinct().collect()]
    if not touched:
        return SilverChange(base, run_id, [], current_parts(spark, path), new_notes)

    rows, kept = valid, None
    present = load_partitions(spark, path, PICKUP_DATE, touched, fmt)
    if present is not None:
        raw = present.select(*BRONZE_COLUMNS, PICKUP_DATE)
        keys = valid.select(*(F.col(name).alias(f"new_{i}") for i, name in enumerate(SORT_KEY)))
        here = [F.col(name).eqNullSafe(F.col(f"new_{i}")) for i, name in enumerate(SORT_KEY)]
        if fits_broadcast(keys, max_rows):
            keys = F.broadcast(keys)
            raw = raw.join(keys, here, "left_semi")
            kept = present.join(keys, here, "left_anti").select(*SILVER_COLUMNS, PICKUP_DATE)
        rows = raw.unionByName(valid)
    if kept is None:
        newest = latest_by_partition(rows, SORT_KEY, "_ingest_ts", tie_breakers, PICKUP_DATE)
    else:
        newest = latest_per_key(rows, SORT_KEY, "_ingest_ts", tie_breakers)
    small = fits_broadcast(zones)
    rows = enrich_zones(trip_metrics(newest), zones, small=small).select(*SILVER_COLUMNS, PICKUP_DATE)
    if kept is not None:
        rows = rows.unionByName(kept)
    balanced = small and kept is None
    parts = replace_partitions(
        rows, path, run_id, PICKUP_DATE, touched, fmt, publish_now=False, balanced=balanced
    )
    return SilverChange(base, run_id, touched, parts, new_notes)
