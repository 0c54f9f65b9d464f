"""Gold: the trip fact, its dimensions, and the serving aggregates."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.codes import payment_label
from tripmart.functions.metrics import hour_label, pickup_partition
from tripmart.functions.totals import mean, total
from tripmart.operators.dedupe import first_per_key, latest_of_repeated, latest_per_key
from tripmart.operators.upsert import upsert_incremental, upsert_partitions
from tripmart.plans import rollups
from tripmart.schemas import PARTITION_UNIT, PICKUP_DATE
from tripmart.sinks.tables import (
    ANY,
    TRANSACTIONAL,
    load_published,
    notes_of,
    Publication,
    overwrite,
    publish_together,
    published,
    replace_partitions,
)
from tripmart.sources.tables import read_table

# Columns of the fact, by their names in silver.
FACT_COLUMNS = [
    "trip_id",
    "vendor_id",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "pickup_zone",
    "dropoff_zone",
    "pickup_borough",
    "dropoff_borough",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "trip_duration_minutes",
    "fare_per_mile",
    "pickup_h3",
    "dropoff_h3",
    "_ingest_ts",
]

# Serving names of the fact's raw columns.
FACT_NAMES = {
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

# How finely a measure is divided (see `totals`), where the caller knows it.
Resolutions = Mapping[str, int]


def fact_trips(silver: DataFrame, rename: bool = True) -> DataFrame:
    """The fact: one row per trip, with serving names unless ``rename`` is off."""
    fact = silver.select(*FACT_COLUMNS)
    return fact.withColumnsRenamed(FACT_NAMES) if rename else fact


def daily_revenue(silver: DataFrame, resolutions: Resolutions | None = None) -> DataFrame:
    """Trips, revenue, mean fare and mean distance per day and vendor."""
    res = resolutions or {}
    # Group on the date and format it afterwards, once per group.
    daily = silver.groupBy(
        F.to_date("tpep_pickup_datetime").alias("day"), F.col("vendor_id")
    ).agg(
        F.count("trip_id").alias("total_trips"),
        total(F.col("total_amount"), res.get("total_amount")).alias("total_revenue"),
        mean(F.col("fare_amount"), res.get("fare_amount")).alias("avg_fare"),
        mean(F.col("trip_distance"), res.get("trip_distance")).alias("avg_distance"),
    )
    return daily.select(
        F.date_format("day", "yyyy-MM-dd").alias("trip_date"),
        "vendor_id",
        "total_trips",
        "total_revenue",
        "avg_fare",
        "avg_distance",
    ).orderBy("trip_date")


def hourly_demand(silver: DataFrame, resolutions: Resolutions | None = None) -> DataFrame:
    """Trips, mean fare and mean duration per hour, cell and zone of the pickup."""
    res = resolutions or {}
    pickup = F.col("tpep_pickup_datetime")
    hourly = silver.groupBy(
        F.to_date(pickup).alias("day"),
        F.hour(pickup).alias("hour"),
        F.col("pickup_h3"),
        F.col("pickup_zone"),
    ).agg(
        F.count("trip_id").alias("trip_count"),
        mean(F.col("fare_amount"), res.get("fare_amount")).alias("avg_fare"),
        mean(F.col("trip_duration_minutes"), res.get("trip_duration_minutes")).alias(
            "avg_trip_duration_minutes"
        ),
    )
    return hourly.select(
        hour_label(F.col("day"), F.col("hour")).alias("pickup_hour"),
        "pickup_h3",
        "pickup_zone",
        "trip_count",
        "avg_fare",
        "avg_trip_duration_minutes",
    ).orderBy("pickup_hour")


def demand_heatmap(silver: DataFrame, resolutions: Resolutions | None = None) -> DataFrame:
    """Trips, mean fare and mean duration per pickup cell."""
    res = resolutions or {}
    return silver.groupBy("pickup_h3").agg(
        F.count("trip_id").alias("trip_count"),
        mean(F.col("fare_amount"), res.get("fare_amount")).alias("avg_fare"),
        mean(F.col("trip_duration_minutes"), res.get("trip_duration_minutes")).alias(
            "avg_trip_duration_minutes"
        ),
    )


def dim_payment(silver: DataFrame) -> DataFrame:
    """Payment codes that occur, with labels."""
    codes = silver.select("payment_type").distinct()
    return codes.withColumn("payment_description", payment_label(F.col("payment_type")))


def zone_tuples(silver: DataFrame) -> DataFrame:
    """Distinct zones of either end of a trip."""
    pickup = F.struct(
        F.col("PULocationID").alias("location_id"),
        F.col("pickup_zone").alias("zone_name"),
        F.col("pickup_borough").alias("borough"),
        F.col("pickup_h3").alias("zone_h3"),
    )
    dropoff = F.struct(
        F.col("DOLocationID").alias("location_id"),
        F.col("dropoff_zone").alias("zone_name"),
        F.col("dropoff_borough").alias("borough"),
        F.col("dropoff_h3").alias("zone_h3"),
    )
    # Both ends from one pass over the trips, where a union would compute silver twice.
    return silver.select(F.inline(F.array(pickup, dropoff))).distinct()


def dim_zone(silver: DataFrame) -> DataFrame:
    """One row per location. Should its attributes differ, the first known ones count."""
    order = [F.col(name).asc_nulls_last() for name in ("zone_name", "borough", "zone_h3")]
    return first_per_key(zone_tuples(silver), ["location_id"], order).orderBy("location_id")


def star_revenue(
    fact: DataFrame,
    payment: DataFrame,
    zone: DataFrame,
    resolutions: Resolutions | None = None,
) -> DataFrame:
    """Trips and revenue per pickup borough, dropoff borough and payment label.

    The fact is summed per key combination before it meets the dimensions, so the joins
    see a handful of rows per zone pair; their sides are small or not as Spark finds them.
    """
    res = (resolutions or {}).get("total_amount")
    keys = ["pickup_location_id", "dropoff_location_id", "payment_type"]
    amount = F.col("total_amount")
    if res is not None:
        amount = F.floor(amount * F.lit(float(res)) + F.lit(0.5))
    summed = fact.groupBy(*keys).agg(
        F.count("trip_id").alias("trips"), F.sum(amount).alias("amount")
    )
    pickup = zone.select(
        F.col("location_id").alias("pickup_location_id"),
        F.col("borough").alias("pickup_borough"),
    )
    dropoff = zone.select(
        F.col("location_id").alias("dropoff_location_id"),
        F.col("borough").alias("dropoff_borough"),
    )
    joined = (
        summed.join(payment, "payment_type", "left")
        .join(pickup, "pickup_location_id", "left")
        .join(dropoff, "dropoff_location_id", "left")
    )
    revenue = F.sum("amount")
    if res is not None:
        revenue = revenue.cast("double") / F.lit(float(res))
    return joined.groupBy("pickup_borough", "dropoff_borough", "payment_description").agg(
        F.sum("trips").alias("total_trips"), revenue.alias("total_revenue")
    )


def run_gold(
    spark: SparkSession,
    silver: DataFrame,
    root: str,
    run_id: str,
    fmt: str = "parquet",
    incremental: bool = False,
    resolutions: Resolutions | None = None,
    partition_unit: str = PARTITION_UNIT,
    silver_path: str | None = None,
) -> dict[str, str]:
    """Write the five gold tables below ``root``; returns their paths.

    Silver is not cached: each table reads only the columns it needs from the columnar
    files, which is less than spilling all of them once. The tables are written at the same
    time, so that the last tasks of one do not keep the cluster waiting, and published
    in one step once all are there. The fact has one row per trip, the newest, and is partitioned
    by pickup date. With ``incremental`` it takes only rows above its high-water mark and
    writes only the dates they touch; if ``silver_path`` names a table of the same partitions, a
    fact made in one go leaves the rows of trips that silver has once where they are. Then also, if ``silver_path`` names the table that ``silver``
    is, the aggregates are made from partial states (see `rollups`), of which only those of date
    partitions that the last refresh of silver touched are computed anew.
    """
    root = root.rstrip("/")
    fact = fact_trips(silver).withColumn(
        PICKUP_DATE, pickup_partition(F.col("tpep_pickup_datetime"), partition_unit)
    )
    ties = [name for name in fact.columns if name not in ("trip_id", "_ingest_ts")]
    tables = {
        "agg_daily_revenue": daily_revenue(silver, resolutions),
        "agg_hourly_demand": hourly_demand(silver, resolutions),
        "dim_payment": dim_payment(silver),
        "dim_zone": dim_zone(silver),
    }
    by_states = incremental and silver_path is not None and fmt not in TRANSACTIONAL
    kept_states = {r.name: r for r in (rollups.DAILY, rollups.HOURLY)} if by_states else {}
    paths = {name: f"{root}/{name}" for name in ("fact_trips", *tables)}
    versioned = fmt not in TRANSACTIONAL
    bases = {name: published(spark, path) if versioned else ANY for name, path in paths.items()}
    present = None
    if incremental:
        present = read_table(spark, paths["fact_trips"], fmt, missing="none")
    if present is not None and PICKUP_DATE not in present.columns:
        present = None  # written before the fact had partitions: build it once more
    parts: dict[str, str] = {}

    @inheritable_thread_target(spark)
    def write(name: str) -> None:
        if name in kept_states:
            states = f"{root}/_states/{name}"
            rollup = kept_states[name]
            change = notes_of(spark, silver_path)
            rollups.refresh(
                spark, rollup, silver_path, states, run_id, change.get("touched"), change.get("follows"), resolutions, fmt
            )
            whole = rollups.merged(rollup, load_published(spark, states, fmt), resolutions)
            overwrite(whole.orderBy(whole.columns[0]), paths[name], run_id, fmt, publish_now=False)
        elif name != "fact_trips":
            overwrite(tables[name], paths[name], run_id, fmt, publish_now=False)
        elif present is None:
            # silver's files lie by the same dates, so rows that do not move stay in that order
            laid = versioned and silver_path is not None and PICKUP_DATE in silver.columns
            whole = latest_of_repeated(fact, ["trip_id"], "_ingest_ts", ties) if laid else None
            balanced = whole is not None
            if whole is None:
                whole = latest_per_key(fact, ["trip_id"], "_ingest_ts", ties)
            overwrite(whole, paths[name], run_id, fmt, [PICKUP_DATE], publish_now=False, balanced=balanced)
        elif not versioned:
            merged = upsert_incremental(present, fact, "trip_id", "_ingest_ts", ties)
            overwrite(merged, paths[name], run_id, fmt, [PICKUP_DATE])
        else:
            rows, touched = upsert_partitions(
                present, fact, "trip_id", "_ingest_ts", PICKUP_DATE, ties
            )
            parts.update(
                replace_partitions(rows, paths[name], run_id, PICKUP_DATE, touched, fmt, publish_now=False)
            )

    with ThreadPoolExecutor(len(paths)) as pool:
        list(pool.map(write, paths))
    if versioned:
        publish_together(
            spark,
            root,
            {
                name: Publication(run_id, bases[name], parts if name == "fact_trips" else None)
                for name in paths
            },
        )
    return paths
