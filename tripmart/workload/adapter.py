"""Trips, zones and raw files in the shapes the library takes, out of the test tables.

Each statement is written once and runs unchanged in Spark SQL (session time zone UTC)
and in DuckDB, so both sides of a comparison start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import prepare_session
from tripmart.sources.tables import read_stream

# _tie1 and _tie2 make the order of the rows of one key total.
TIES = ["_tie1", "_tie2"]

TRIPS_SQL = """
select
  concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as trip_id,
  cast(l_suppkey % 2 + 1 as int) as vendor_id,
  cast(o_orderdate as timestamp) as tpep_pickup_datetime,
  cast(l_shipdate as timestamp) as tpep_dropoff_datetime,
  cast(l_linenumber as int) as passenger_count,
  l_quantity - 1.0e0 as trip_distance,
  case when l_returnflag = 'N' then null
       else cast(l_linenumber % 6 + 1 as int) end as RatecodeID,
  case when l_linestatus = 'F' then 'Y' else 'N' end as store_and_fwd_flag,
  cast(c_nationkey as int) as PULocationID,
  cast(s_nationkey as int) as DOLocationID,
  cast(substring(o_orderpriority, 1, 1) as int)
    + case when l_linenumber = 7 then 2 else 0 end as payment_type,
  case when l_returnflag = 'R' and l_linenumber = 1
       then -l_extendedprice / 100.0e0 else l_extendedprice / 100.0e0 end as fare_amount,
  0.5e0 as extra,
  l_tax as mta_tax,
  l_discount as tip_amount,
  0.0e0 as tolls_amount,
  0.3e0 as improvement_surcharge,
  l_extendedprice as total_amount,
  case when l_linestatus = 'F' then null else 2.5e0 end as congestion_surcharge,
  case when l_linestatus = 'F' then null else 1.75e0 end as airport_fee,
  case when l_linestatus = 'F' then null
       else timestamp '2024-01-01 00:00:00' + l_partkey * interval '1' second end as kafka_ts,
  timestamp '2024-01-01 00:00:00' + l_partkey * interval '1' second as _ingest_ts,
  case when l_linestatus = 'F' then 'historical_parquet' else 'kafka_live' end as record_source,
  l_suppkey as _tie1,
  l_extendedprice as _tie2
from {lineitem}
join {orders} on l_orderkey = o_orderkey
join {customer} on o_custkey = c_custkey
join {supplier} on l_suppkey = s_suppkey
"""

# What a cluster joins: the narrow orders meet their customers before the wide lines meet both, so
# the lines are shuffled once. The rows are those of `TRIPS_SQL`.
_TRIPS_FROM = """from {lineitem}
join (
  select o_orderkey, o_orderdate, o_orderpriority, c_nationkey from {orders} join {customer} on o_custkey = c_custkey
) on l_orderkey = o_orderkey
join {supplier} on l_suppkey = s_suppkey
"""
SPARK_TRIPS_SQL = TRIPS_SQL.partition("from {lineitem}")[0] + _TRIPS_FROM

# A zone at a zero latitude and a zone that is not listed are there on purpose.
ZONES_SQL = """
select
  cast(n_nationkey as int) as LocationID,
  n_name as Zone,
  r_name as Borough,
  case when n_nationkey = 0 then 0.0e0 else 40.55e0 + 0.01e0 * n_nationkey end as lat,
  -74.05e0 + 0.013e0 * n_nationkey as lon
from {nation}
join {region} on n_regionkey = r_regionkey
where n_nationkey < 24
"""

# A list of places that grows with the data: one per customer, spread over a city.
PLACES_SQL = """
select
  c_custkey as LocationID,
  c_name as Zone,
  c_mktsegment as Borough,
  40.4e0 + (c_acctbal + 1000.0e0) * 0.00006e0 as lat,
  -74.3e0 + (c_custkey % 10007) * 0.00007e0 as lon
from {customer}
"""

# Places all over the globe, around ten latitudes, one per customer; the first have no position.
GLOBE_SQL = """
select
  c_custkey as LocationID,
  case when c_custkey <= 3 then 0.0e0
       else -85.0e0 + (c_custkey % 10) * 18.9e0 + c_acctbal * 0.00031e0 end as lat,
  -179.3e0 + (c_custkey % 10007) * 0.0353e0 + c_acctbal * 0.0000071e0 as lon
from {customer}
"""

# A raw file before normalisation: old names, floating codes, gaps, no trip_id.
RAW_FILE_SQL = """
select
  cast(case when payment_type = 7 then null else vendor_id end as bigint) as VendorID,
  tpep_pickup_datetime,
  tpep_dropoff_datetime,
  cast(case when RatecodeID is null then null else passenger_count end as double)
    as passenger_count,
  case when trip_distance = 0.0e0 then null else trip_distance end as trip_distance,
  cast(RatecodeID as double) as RatecodeID,
  case when RatecodeID is null then null else store_and_fwd_flag end as store_and_fwd_flag,
  PULocationID,
  DOLocationID,
  cast(payment_type as bigint) as payment_type,
  fare_amount,
  extra,
  mta_tax,
  tip_amount,
  tolls_amount,
  improvement_surcharge,
  total_amount,
  congestion_surcharge,
  airport_fee as Airport_fee
from {trips}
"""

# Trips as text, with values that cannot be read.
TEXT_SQL = """
select
  trip_id,
  cast(vendor_id as string) as vendor_id,
  case when passenger_count = 7 then 'unknown'
       else cast(tpep_pickup_datetime as string) end as tpep_pickup_datetime,
  case when passenger_count = 6 then ''
       else cast(tpep_dropoff_datetime as string) end as tpep_dropoff_datetime,
  case when passenger_count = 5 then 'n/a'
       else cast(passenger_count as string) end as passenger_count,
  cast(trip_distance as string) as trip_distance,
  cast(RatecodeID as string) || '.0' as RatecodeID,
  cast(PULocationID as string) as PULocationID,
  case when DOLocationID = 3 then '99999999999' else cast(DOLocationID as string) end
    as DOLocationID,
  cast(payment_type as string) as payment_type,
  case when payment_type = 6 then 'free' else cast(fare_amount as string) end as fare_amount,
  cast(tip_amount as string) as tip_amount,
  cast(total_amount as string) as total_amount
from {trips}
"""

# What arrives at bronze one batch after the other: the seed, the live rows, corrections (some of
# which move a trip by forty days), and rows that are older than what is there, some of new trips.
_BRONZE = """
  vendor_id, {dropoff} as tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID,
  store_and_fwd_flag, PULocationID, DOLocationID, payment_type, {fare} as fare_amount, extra,
  mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
  airport_fee, {stamp} as kafka_ts, {ingest} as _ingest_ts, {source} as record_source
from {{trips}} where {where}
"""


def _batch(where: str, **changed: str) -> str:
    fields = {
        "dropoff": "tpep_dropoff_datetime",
        "fare": "fare_amount",
        "stamp": "kafka_ts",
        "ingest": "_ingest_ts",
        "source": "record_source",
    } | changed
    key = fields.pop("key", "trip_id")
    pickup = fields.pop("pickup", "tpep_pickup_datetime")
    rest = _BRONZE.format(where=where, **fields)
    return f"select {key} as trip_id, {pickup} as tpep_pickup_datetime, {rest}"


BATCHES_SQL = {
    "seed": _batch("record_source = 'historical_parquet'"),
    "live": _batch("record_source = 'kafka_live'"),
    "correction": _batch(
        "passenger_count = 1",
        fare="fare_amount + 1.0e0",
        ingest="_ingest_ts + interval '1' day",
        pickup="case when RatecodeID is null then tpep_pickup_datetime - interval '40' day else tpep_pickup_datetime end",
        source="'kafka_live'",
    ),
    "late": _batch(
        "passenger_count = 2",
        key="case when PULocationID = 3 then concat(trip_id, '-late') else trip_id end",
        fare="fare_amount + 2.0e0",
        ingest="_ingest_ts - interval '1' day",
        source="'kafka_live'",
    ),
}

# The amounts of these trips have at most four decimals, their distances none, and their
# durations are whole seconds.
RESOLUTIONS = {
    "fare_amount": 10_000,
    "total_amount": 100,
    "trip_distance": 1,
    "trip_duration_minutes": 60,
}


# Schemas by path, as a catalog would keep them: a footer is opened once per table.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def trips(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped trips. A streaming ``lineitem`` makes them a stream."""
    names = ["orders", "customer", "supplier"]
    tables = {name: table(spark, sf_dir, name) for name in names}
    if lineitem is None:
        lineitem = table(spark, sf_dir, "lineitem")
    return spark.sql(SPARK_TRIPS_SQL, lineitem=lineitem, **tables)


def live_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    source = read_stream(spark, "parquet", lines.schema, f"{sf_dir}/lineitem.parquet")
    return trips(spark, sf_dir, dealt(source, lines))


def dealt(source: DataFrame, files: DataFrame) -> DataFrame:
    """A stream's rows over all cores: a file that is one split would else be decoded by one task.

    ``files`` is the table the stream reads. Where its files make a task per core, nothing moves.
    """
    cores = source.sparkSession.sparkContext.defaultParallelism
    return source if files.rdd.getNumPartitions() >= cores else source.repartition(cores)


def batch(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """What arrives under a name, out of ``rows`` (see `trips`)."""
    return spark.sql(BATCHES_SQL[name], trips=rows)


def zone_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup under the names its file has."""
    tables = {name: table(spark, sf_dir, name) for name in ("nation", "region")}
    return spark.sql(ZONES_SQL, **tables)


FILE_NAMES = {"Zone": "zone_name", "Borough": "borough"}


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_file(spark, sf_dir).withColumnsRenamed(FILE_NAMES)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_file(spark, sf_dir).withColumnsRenamed(FILE_NAMES)


def globe_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GLOBE_SQL, customer=table(spark, sf_dir, "customer"))


def place_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places under the names a zone lookup file has."""
    return spark.sql(PLACES_SQL, customer=table(spark, sf_dir, "customer"))


def raw_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_FILE_SQL, trips=trips(spark, sf_dir))


def text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TEXT_SQL, trips=trips(spark, sf_dir))


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, which read the same in every client."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
