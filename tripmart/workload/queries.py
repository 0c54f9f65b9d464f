"""One query per operator of the library."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.frames import decode_frames, frame_rows
from tripmart.functions.globe import globe_neighbours, globe_parent
from tripmart.functions.lineage import LIVE_SOURCE, add_lineage
from tripmart.functions.registry import decode_by_id, read_schemas, write_schemas
from tripmart.operators.check_states import refresh_checks
from tripmart.operators.checks import Check, QualityError, evaluate, orphans_of, verdict
from tripmart.operators.clean import trip_metrics, type_trips, valid_trips
from tripmart.operators.dedupe import latest_per_key
from tripmart.functions.metrics import pickup_partition
from tripmart.operators.upsert import upsert_incremental, upsert_partitions
from tripmart.operators.zones import enrich_zones, zone_cells
from tripmart.plans import audit, gold, rollups
from tripmart.plans.bronze import bronze_union as union_origins
from tripmart.plans.bronze import read_bronze, run_bronze
from tripmart.plans.medallion import LakeConfig, run_pipeline
from tripmart.plans.silver import TIE_BREAKERS, clean_trips, refresh_silver
from tripmart.plans.silver import silver_trips as silver_plan
from tripmart.schemas import PICKUP_DATE, SILVER_COLUMNS, SILVER_KEY, TIME_COLUMNS, TRIP_COLUMNS, TRIP_SCHEMA
from tripmart.session import scratch_path
from tripmart.sinks.byfile import upsert_files
from tripmart.sinks.tables import append_merge, compact, overwrite, read_origins, replace_partitions
from tripmart.sources.tables import read_stream, read_table, read_zones, register
from tripmart.sources.tables import scan_history as scan_files
from tripmart.sources.trips import first_trips as first_rows
from tripmart.sources.trips import normalize_trips as normalize
from tripmart.sources.trips import surrogate_trip_id as surrogate
from tripmart.streaming.dedupe import stream_dedupe as dedupe_events
from tripmart.streaming.landing import LIVE, QUARANTINE, land_checked, land_stream
from tripmart.streaming.newest import keep_newest, read_newest
from tripmart.workload import adapter
from tripmart.workload.adapter import RESOLUTIONS, TIES, naive

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(adapter.trips(spark, sf_dir), TIES)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_plan(adapter.trips(spark, sf_dir), adapter.zones(spark, sf_dir), TIES)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table, for a query that reads it more than once."""
    path = scratch_path(df.sparkSession, name)
    overwrite(df, path, "1")
    return read_table(df.sparkSession, path)


# Sources


@_query("scan_history")
def scan_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A historical file whose ids are numbers."""
    path = scratch_path(spark, "numbered")
    adapter.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "trip_id").write.parquet(path)
    return scan_files(spark, path)


@_query("drifting_history")
def drifting_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose files have three schemas: wider types, another case, columns that come and go."""
    path, trips = scratch_path(spark, "drifting"), adapter.trips(spark, sf_dir)
    common = [F.col("trip_id"), F.col("PULocationID"), F.col("passenger_count")]
    first = trips.filter("vendor_id = 1 and payment_type < 4").select(
        *common, "fare_amount", F.col("airport_fee").alias("Airport_fee"), "store_and_fwd_flag"
    )
    second = trips.filter("vendor_id = 2").select(
        "trip_id",
        F.col("PULocationID").cast("long"),
        F.col("passenger_count").cast("long"),
        F.floor("fare_amount").alias("fare_amount"),
        "airport_fee",
        F.concat(F.lit("c"), F.col("vendor_id")).alias("cab_colour"),
    )
    counted = F.when(F.col("passenger_count") == 3, "n/a").otherwise(F.col("passenger_count").cast("string"))
    third = trips.filter("vendor_id = 1 and payment_type >= 4").select(
        "trip_id", "PULocationID", counted.alias("passenger_count"), "fare_amount", "store_and_fwd_flag"
    )
    for rows in (first, second, third):
        rows.write.mode("append").parquet(path)
    found = scan_files(spark, path)
    # which file is listed first, and so which spelling counts, is left to chance
    return found.withColumnRenamed("airport_fee", "Airport_fee")


@_query("named_source")
def named_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL model over a table under its name."""
    register(adapter.trips(spark, sf_dir), "bronze_trips_source")
    return spark.sql(
        "select payment_type, count(*) as trips, max(fare_amount) as max_fare "
        "from bronze_trips_source group by payment_type"
    )


@_query("zone_lookup")
def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "zones-csv")
    adapter.place_file(spark, sf_dir).write.option("header", True).csv(path)
    return read_zones(spark, path)


@_query("normalize_trips")
def normalize_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(adapter.raw_file(spark, sf_dir))


@_query("first_trips")
def first_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The limit is the operator: the first 10,000 rows in a total order.
    order = ["tpep_pickup_datetime", "trip_id", "_ingest_ts", *TIES]
    rows = first_rows(adapter.trips(spark, sf_dir), 10_000, order)
    return naive(rows.select("trip_id", "tpep_pickup_datetime", "total_amount"))


@_query("surrogate_trip_id")
def surrogate_trip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate(normalize(adapter.raw_file(spark, sf_dir)))


# Cleaning and enrichment


@_query("typed_trips")
def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(type_trips(adapter.text_trips(spark, sf_dir)))


@_query("trip_metrics")
def measured_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_metrics(adapter.trips(spark, sf_dir)).select(
        "trip_id", *TIES, "trip_duration_minutes", "fare_per_mile"
    )


@_query("valid_trips")
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(valid_trips(adapter.trips(spark, sf_dir)))


@_query("zone_cells")
def cells_of_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = adapter.places(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [zone_cells(places, res).withColumn("res", F.lit(res)) for res in (7, 9, 12)],
    )


@_query("globe_cells")
def cells_of_globe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of places all over the globe, with their parents and neighbours."""
    # a customer file is few splits, and cells are dear: their rows go over all cores
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = adapter.globe_places(spark, sf_dir).repartition(tasks)
    found = [zone_cells(places, res, "globe").withColumn("res", F.lit(res)) for res in (4, 9)]
    return reduce(DataFrame.unionByName, found).select(
        "LocationID",
        "res",
        "cell",
        globe_parent(F.col("cell")).alias("parent"),
        F.array_join(globe_neighbours(F.col("cell")), ",").alias("neighbours"),
    )


@_query("enrich_zones")
def enriched_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = adapter.trips(spark, sf_dir).select(*SILVER_KEY, "PULocationID", "DOLocationID", *TIES)
    return naive(enrich_zones(trips, adapter.zones(spark, sf_dir)))


@_query("latest_per_key")
def latest_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(latest_per_key(adapter.trips(spark, sf_dir), SILVER_KEY, "_ingest_ts", TIES))


@_query("silver_trips")
def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(_silver(spark, sf_dir))


# Gold


@_query("fact_trips_raw")
def fact_trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(gold.fact_trips(_silver(spark, sf_dir), rename=False))


@_query("fact_trips")
def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(gold.fact_trips(_silver(spark, sf_dir)))


@_query("fact_incremental")
def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of the silver table into a fact that was built from its first 15 minutes."""
    trips, zones = adapter.trips(spark, sf_dir), adapter.zones(spark, sf_dir)
    early = trips.filter(F.col("_ingest_ts") <= F.lit("2024-01-01 00:15:00").cast("timestamp"))
    merged = upsert_incremental(
        _written(gold.fact_trips(silver_plan(early, zones, TIES)), "fact"),
        _written(gold.fact_trips(silver_plan(trips, zones, TIES)), "increment"),
        "trip_id",
        "_ingest_ts",
        ["tpep_pickup_datetime"],
    )
    return naive(merged)


@_query("fact_by_file")
def fact_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert into a fact that is kept by file."""
    trips, zones = adapter.trips(spark, sf_dir), adapter.zones(spark, sf_dir)
    early = trips.filter(F.col("_ingest_ts") <= F.lit("2024-01-01 00:15:00").cast("timestamp"))
    path = scratch_path(spark, "by-file")
    fact = gold.fact_trips(silver_plan(early, zones, TIES)).hint("rebalance", F.col("trip_id"))
    overwrite(fact, path, "1", bloom=["trip_id"])
    source = _written(gold.fact_trips(silver_plan(trips, zones, TIES)), "increment")
    upsert_files(spark, path, source, "trip_id", "_ingest_ts", "2", ["tpep_pickup_datetime"])
    return naive(read_table(spark, path))


@_query("incremental_aggregates")
def incremental_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert into a partitioned fact, and the aggregates that follow it by their states."""
    trips, zones = adapter.trips(spark, sf_dir), adapter.zones(spark, sf_dir)
    early = trips.filter(F.col("_ingest_ts") <= F.lit("2024-01-01 00:15:00").cast("timestamp"))
    root = scratch_path(spark, "states")
    path = f"{root}/fact"

    def dated(source: DataFrame) -> DataFrame:
        day = pickup_partition(F.col("tpep_pickup_datetime"), "year")
        return gold.fact_trips(silver_plan(source, zones, TIES)).withColumn(PICKUP_DATE, day)

    def follow(touched: list | None = None, follows: str | None = None) -> None:
        for rollup in rollups.ROLLUPS:
            states = f"{root}/{rollup.name}"
            run = "1" if follows is None else "2"
            rollups.refresh(spark, rollup, path, states, run, touched, follows, RESOLUTIONS)

    overwrite(dated(early), path, "1", partition_by=[PICKUP_DATE])
    follow()
    source = _written(dated(trips), "increment")
    rows, touched = upsert_partitions(
        read_table(spark, path), source, "trip_id", "_ingest_ts", PICKUP_DATE, ["tpep_pickup_datetime"]
    )
    replace_partitions(rows, path, "2", PICKUP_DATE, touched)
    follow(touched, "1")
    found = [
        rollups.merged(r, read_table(spark, f"{root}/{r.name}"), RESOLUTIONS).withColumn("aggregate", F.lit(r.name))
        for r in rollups.ROLLUPS
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips all batches come from, joined once."""
    return _written(adapter.trips(spark, sf_dir).drop(*TIES), "arrivals")


def _arrive(spark: SparkSession, trips: DataFrame, path: str, *names: str) -> None:
    """Append batches to bronze, the seed as history and the others as live ones."""
    texts = {name: F.col(name).cast("string") for name in TIME_COLUMNS}
    for name in names:
        rows = adapter.batch(spark, name, trips).withColumns(texts)
        append_merge(rows, path, "seed" if name == "seed" else "live", name)


@_query("incremental_silver")
def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a seed, live rows, corrections that move trips, and late rows, one by one."""
    root = scratch_path(spark, "growing")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    trips = _arrivals(spark, sf_dir)
    for run in ("seed", "live", "correction", "late"):
        _arrive(spark, trips, bronze, run)
        change = refresh_silver(
            spark, bronze, adapter.zones(spark, sf_dir), silver, run, partition_unit="year"
        )
        change.publish(spark, silver)
    return naive(read_table(spark, silver).select(*SILVER_COLUMNS))


@_query("incremental_demand")
def incremental_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two gated runs over a lake whose bronze grows between them; the hourly table of the second."""
    cfg = _config(spark, sf_dir, scratch_path(spark, "growing-lake"), bronze=False)
    cfg.incremental, cfg.tie_breakers = True, TIE_BREAKERS
    cfg.suite = [check for check in cfg.suite if check.kind != "duplicates"]
    trips = _arrivals(spark, sf_dir)
    for run, names in (("1", ["seed", "live"]), ("2", ["correction", "late"])):
        _arrive(spark, trips, cfg.bronze_path, *names)
        tables = run_pipeline(spark, cfg, run)
    return read_table(spark, tables["agg_hourly_demand"])


@_query("daily_revenue")
def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_revenue(_clean(spark, sf_dir), RESOLUTIONS)


@_query("hourly_demand")
def hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly_demand(_silver(spark, sf_dir), RESOLUTIONS)


@_query("demand_heatmap")
def demand_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.demand_heatmap(_silver(spark, sf_dir), RESOLUTIONS)


@_query("dim_payment")
def dim_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_payment(_clean(spark, sf_dir))


@_query("dim_zone")
def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_zone(_silver(spark, sf_dir))


@_query("zone_tuples")
def zone_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.zone_tuples(_silver(spark, sf_dir))


@_query("star_revenue")
def star_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _written(_silver(spark, sf_dir).select(*gold.FACT_COLUMNS), "star")
    return gold.star_revenue(
        gold.fact_trips(silver), gold.dim_payment(silver), gold.dim_zone(silver), RESOLUTIONS
    )


# Tables


def _origins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    trips = adapter.trips(spark, sf_dir).drop(*TIES)
    live = trips.filter(F.col("record_source") == LIVE_SOURCE)
    history = trips.filter(F.col("record_source") != LIVE_SOURCE).drop("kafka_ts")
    return history, live


@_query("bronze_union")
def bronze_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(union_origins(*_origins(spark, sf_dir)))


@_query("append_merge")
def appended_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through the table; the repeated seed must not double anything."""
    path = scratch_path(spark, "bronze")
    history, live = _origins(spark, sf_dir)
    texts = {name: F.col(name).cast("string") for name in TIME_COLUMNS}
    for df, origin in ((history, "seed"), (history, "seed"), (live, "live")):
        append_merge(df.withColumns(texts), path, origin, "0")
    return naive(read_bronze(spark, path))


def _history_files(spark: SparkSession, sf_dir: str) -> str:
    """A raw file with one column more than the trip record has, and fares that are no numbers."""
    path = scratch_path(spark, "history")
    raw = adapter.raw_file(spark, sf_dir)
    raw.withColumn("fare_amount", F.when(F.col("payment_type") == 6, "n/a").otherwise(
        F.col("fare_amount").cast("string")
    )).withColumn("cab_colour", F.concat(F.lit("c"), F.col("VendorID").cast("string"))).write.parquet(path)
    return path


_STAMP = dt.datetime(2024, 2, 1)


@_query("seeded_bronze")
def seeded_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze out of a raw file: ids, all columns, NULL where a fare cannot be read."""
    table = run_bronze(
        spark, scratch_path(spark, "seeded"), _history_files(spark, sf_dir), ingest_ts=_STAMP
    )
    return naive(table.drop("kafka_ts"))


@_query("bronze_rerun")
def bronze_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed, a live correction of every trip, and the seed job once more: the correction counts."""
    path, history = scratch_path(spark, "rerun"), _history_files(spark, sf_dir)
    seeded = run_bronze(spark, path, history, ingest_ts=_STAMP)
    corrected = seeded.select(*TRIP_COLUMNS).withColumn("fare_amount", F.lit(12.0))
    append_merge(
        add_lineage(corrected, LIVE_SOURCE, dt.datetime(2024, 2, 2)), path, "live", "0"
    )
    again = run_bronze(spark, path, history)
    latest = latest_per_key(again, ["trip_id"], "_ingest_ts", ["total_amount"])
    return latest.groupBy("record_source", "fare_amount").agg(F.count("*").alias("trips"))


@_query("gated_rejection")
def gated_rejection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after a first run whose audit failed, and after a good one."""
    root = scratch_path(spark, "gated")
    cfg = _config(spark, sf_dir, root)
    bad = Check("row_count", above=2**62)
    cfg.suite = [*cfg.suite, bad]
    try:
        run_pipeline(spark, cfg, "1")
    except QualityError:
        pass
    places = {"silver": cfg.silver_path, "fact": f"{cfg.gold_path}/fact_trips"}

    def seen(run: str) -> DataFrame:
        found = {k: read_table(spark, p, missing="none") for k, p in places.items()}
        empty = spark.createDataFrame([], "trip_id string")
        counts = [
            (empty if t is None else t).agg(F.count("trip_id").alias("trips")).select(
                F.lit(run).alias("run"), F.lit(k).alias("layer"), "trips"
            )
            for k, t in found.items()
        ]
        return reduce(DataFrame.unionByName, counts)

    rejected = seen("rejected")
    cfg.suite.remove(bad)
    run_pipeline(spark, cfg, "2")
    return rejected.unionByName(seen("published"))


@_query("compact_roundtrip")
def compact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "compact")
    overwrite(_silver(spark, sf_dir), path, "1")
    compact(spark, path, "2", ["tpep_pickup_datetime", "pickup_h3"])
    return naive(read_table(spark, path))


@_query("published_demand")
def published_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gated run over all layers, read back from its hourly table."""
    return read_table(spark, gated_run(spark, sf_dir)["agg_hourly_demand"])


def gated_run(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All layers in a fresh folder. These trips last days and some have no cell by
    design, so the suite is the table suite plus the silver key."""
    return run_pipeline(spark, _config(spark, sf_dir, scratch_path(spark, "lake")))


def _config(spark: SparkSession, sf_dir: str, root: str, bronze: bool = True) -> LakeConfig:
    return LakeConfig(
        root=root,
        zones=adapter.zones(spark, sf_dir),
        # a table, as in a lake: every run reads it more than once
        bronze=_written(adapter.trips(spark, sf_dir), "bronze") if bronze else None,
        suite=[*audit.table_suite(), Check("unique", SILVER_KEY)],
        tie_breakers=TIES,
        resolutions=RESOLUTIONS,
        # these trips are spread over seven years
        partition_unit="year",
    )


# Streams


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of framed trips, fed by the growing file of a table."""
    live = adapter.live_trips(spark, sf_dir)
    records = normalize(live)
    framed = frame_rows(records, "trip_id", schema_id=7)
    return framed.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def _land(df: DataFrame, path: str) -> None:
    land_stream(df, path, f"{path}/checkpoint").awaitTermination()


@_query("stream_decode")
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "decode")
    _land(decode_frames(_messages(spark, sf_dir), header=True), path)
    return naive(read_origins(spark, path, ["live"]))


@_query("stream_land")
def stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "land")
    _land(add_lineage(decode_frames(_messages(spark, sf_dir)), LIVE_SOURCE), path)
    return read_bronze(spark, path).select(*TRIP_COLUMNS, "record_source")


@_query("stream_restart")
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three starts of one stream, with new input before the second."""
    path, lines = scratch_path(spark, "restart"), scratch_path(spark, "lines")
    table = adapter.table(spark, sf_dir, "lineitem")
    read_files = spark.read.schema(table.schema).parquet
    for half in (0, 1, None):
        if half is not None:
            table.filter(F.col("l_orderkey") % 2 == half).write.mode("append").parquet(lines)
        source = read_stream(spark, "parquet", table.schema, lines)
        trips = adapter.trips(spark, sf_dir, adapter.dealt(source, read_files(lines)))
        framed = frame_rows(normalize(trips), "trip_id", schema_id=7)
        stamped = framed.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
        _land(add_lineage(decode_frames(stamped), LIVE_SOURCE), path)
    return read_bronze(spark, path).select(*TRIP_COLUMNS, "record_source")


def _writers() -> dict[int, T.StructType]:
    """The trip record as three writers know it: today's, an old one, and a newer one."""
    old = {"vendor_id": "VendorID"}
    gone = {"passenger_count", "store_and_fwd_flag", "extra", "tolls_amount", "airport_fee"}
    earlier = [
        T.StructField(
            old.get(f.name, f.name),
            T.LongType() if isinstance(f.dataType, T.IntegerType) or f.name == "trip_distance" else f.dataType,
            f.nullable,
        )
        for f in TRIP_SCHEMA
        if f.name not in gone
    ]
    later = [
        T.StructField(f.name, T.StringType() if f.name == "fare_amount" else f.dataType, f.nullable)
        for f in TRIP_SCHEMA
    ]
    return {
        11: TRIP_SCHEMA,
        12: T.StructType(earlier),
        13: T.StructType([*later, T.StructField("cab_colour", T.StringType())]),
    }


def _checked_topic(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """Half a topic: messages of three writers, of an unknown one, and broken ones.

    ``offset`` numbers the messages of a partition, as a topic does.
    """
    trips = adapter.trips(spark, sf_dir).filter((F.col("_tie1") % 2 == part))
    records = normalize(trips)
    records = records.withColumns({"VendorID": F.col("vendor_id"), "cab_colour": F.lit("red")})
    kinds = {11: "vendor_id = 1 and payment_type < 4", 12: "vendor_id = 2", 13: "vendor_id = 1 and payment_type >= 4"}
    writers = {
        schema_id: (F.expr(rows), F.struct(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in _writers()[schema_id])))
        for schema_id, rows in kinds.items()
    }
    found = frame_rows(records, "trip_id", writers=writers)
    # what happens to a message is told by its key
    number = F.crc32("key")
    value = F.col("value")
    broken = (
        F.when(number % 11 == 0, F.concat(F.unhex(F.lit("0000000063")), F.substring(value, 6, 2**31 - 1)))
        .when(number % 11 == 1, F.substring(value, 1, 60))
        .when(number % 11 == 2, F.substring(value, 1, 3))
        .when(number % 11 == 3, F.encode(F.regexp_replace(F.decode(value, "UTF-8"), '"trip_id":"[^"]*"', '"trip_id":null'), "UTF-8"))
        .otherwise(value)
    )
    return found.select(
        "key",
        broken.alias("value"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        (number % 4).cast("int").alias("partition"),
        number.alias("offset"),
    )


def _checked_stream(spark: SparkSession, sf_dir: str) -> str:
    """Land the topic in two starts of one stream, and a third that finds nothing new."""
    path, topic, known = (scratch_path(spark, n) for n in ("checked", "topic", "schemas"))
    write_schemas(spark, _writers(), known)
    for part in (0, 1, None):
        if part is not None:
            _checked_topic(spark, sf_dir, part).write.mode("append").parquet(topic)
        messages = read_stream(spark, "parquet", spark.read.parquet(topic).schema, topic)
        decoded = decode_by_id(messages, read_schemas(spark, known))
        land_checked(add_lineage(decoded, LIVE_SOURCE), path, f"{path}/checkpoint").awaitTermination()
    return path


@_query("stream_schemas")
def stream_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic of three writers as rows of one schema; broken messages do not stop it."""
    path = _checked_stream(spark, sf_dir)
    return read_origins(spark, path, [LIVE]).select(*TRIP_COLUMNS, "frame_schema_id")


@_query("stream_quarantine")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the topic landed and what was kept apart, by reason."""
    path = _checked_stream(spark, sf_dir)
    good = read_origins(spark, path, [LIVE]).select(
        F.lit("landed").alias("side"), F.lit(None).cast("string").alias("reason"), "frame_schema_id",
        F.crc32(F.encode("trip_id", "UTF-8")).alias("offset"),
    )
    bad = read_origins(spark, path, [QUARANTINE]).select(
        F.lit("quarantine").alias("side"), "reason", "frame_schema_id", "offset"
    )
    return good.unionByName(bad).groupBy("side", "reason", "frame_schema_id").agg(
        F.count("*").alias("messages"), F.count_distinct("offset").alias("offsets"), F.sum("offset").alias("offset_sum")
    )


@_query("stream_newest")
def stream_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event per user out of five starts of a stream, events in no order of time."""
    path, topic = scratch_path(spark, "newest"), scratch_path(spark, "shuffled")
    events = adapter.table(spark, sf_dir, "events")
    by = (["user_id"], "ts", ["event_id"])
    for part in range(5):
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(5)) == part).write.mode("append").parquet(topic)
        stream = read_stream(spark, "parquet", events.schema, topic)
        keep_newest(stream, path, f"{path}/checkpoint", *by, delay="12 hours", fold_every=3).awaitTermination()
    return naive(read_newest(spark, path, *by))


# Files a batch of the repeated topic has: a batch is read and written by so many tasks.
_FILES = 8


@_query("stream_dedupe")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic in five batches, each of which repeats the last hours of the one before."""
    path, topic = scratch_path(spark, "dedupe"), scratch_path(spark, "events")
    events = adapter.table(spark, sf_dir, "events")
    for first in range(0, 30, 6):
        start = F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(days=first)).cast(events.schema["ts"].dataType)
        end = start + F.expr("interval 6 days")
        # the first and the last batch take what lies before and after
        since = F.lit(True) if first == 0 else F.col("ts") >= start - F.expr("interval 3 hours")
        until = F.lit(True) if first == 24 else F.col("ts") < end
        events.filter(since & until).repartition(_FILES).write.mode("append").parquet(topic)
    stream = read_stream(spark, "parquet", events.schema, topic, maxFilesPerTrigger=str(_FILES))
    _land(dedupe_events(stream, ["event_id"], "ts", "12 hours"), path)
    return naive(read_origins(spark, path, ["live"]))


# Quality


@_query("dq_report")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(_written(_silver(spark, sf_dir), "audited"), audit.silver_suite())


@_query("dq_incremental")
def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver suite and repeated ids over a growing silver, from states of its partitions."""
    root = scratch_path(spark, "checked")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    suite = [*audit.silver_suite(), Check("duplicates", "trip_id")]
    trips = _arrivals(spark, sf_dir)
    for run, names in (("1", ["seed", "live"]), ("2", ["correction", "late"])):
        _arrive(spark, trips, bronze, *names)
        change = refresh_silver(spark, bronze, adapter.zones(spark, sf_dir), silver, run, partition_unit="year")
        checked = refresh_checks(
            spark, suite, silver, f"{root}/checks", run, run, change.parts, change.touched, change.base, buckets=16
        )
        change.publish(spark, silver)
        checked.publish()
    return checked.report


@_query("dq_verdict")
def dq_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _written(_silver(spark, sf_dir), "audited")
    suites = {"silver": audit.silver_suite(), "table": audit.metric_suite()}
    return reduce(
        DataFrame.unionByName,
        [
            verdict(evaluate(silver, suite)).withColumn("suite", F.lit(name))
            for name, suite in suites.items()
        ],
    )


@_query("dq_unique")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [Check("unique", SILVER_KEY), Check("duplicates", "trip_id")]
    return evaluate(adapter.trips(spark, sf_dir), checks)


@_query("dq_table_metrics")
def dq_table_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(_clean(spark, sf_dir), audit.metric_suite())


@_query("dq_schema")
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(_written(_silver(spark, sf_dir), "audited"), audit.schema_suite())


@_query("dq_orphans")
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = adapter.trips(spark, sf_dir)
    zones = adapter.zones(spark, sf_dir)
    payments = gold.dim_payment(_clean(spark, sf_dir))
    return orphans_of(
        trips,
        {
            "payment": (payments, {"payment_type": "payment_type"}),
            "pickup": (zones, {"PULocationID": "LocationID"}),
            "dropoff": (zones, {"DOLocationID": "LocationID"}),
        },
    )
