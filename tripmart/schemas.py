"""Schemas and column lists shared by the layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, types and nullability of the trip record.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("trip_id", T.StringType(), False),
        T.StructField("vendor_id", T.IntegerType(), False),
        T.StructField("tpep_pickup_datetime", T.StringType(), False),
        T.StructField("tpep_dropoff_datetime", T.StringType(), False),
        T.StructField("passenger_count", T.IntegerType(), True),
        T.StructField("trip_distance", T.DoubleType(), False),
        T.StructField("RatecodeID", T.IntegerType(), True),
        T.StructField("store_and_fwd_flag", T.StringType(), True),
        T.StructField("PULocationID", T.IntegerType(), False),
        T.StructField("DOLocationID", T.IntegerType(), False),
        T.StructField("payment_type", T.IntegerType(), False),
        T.StructField("fare_amount", T.DoubleType(), False),
        T.StructField("extra", T.DoubleType(), False),
        T.StructField("mta_tax", T.DoubleType(), False),
        T.StructField("tip_amount", T.DoubleType(), False),
        T.StructField("tolls_amount", T.DoubleType(), False),
        T.StructField("improvement_surcharge", T.DoubleType(), False),
        T.StructField("total_amount", T.DoubleType(), False),
        T.StructField("congestion_surcharge", T.DoubleType(), True),
        T.StructField("airport_fee", T.DoubleType(), True),
    ]
)

LINEAGE_FIELDS = [
    T.StructField("kafka_ts", T.TimestampType(), True),
    T.StructField("_ingest_ts", T.TimestampType(), True),
    T.StructField("record_source", T.StringType(), True),
]

BRONZE_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in TRIP_SCHEMA] + LINEAGE_FIELDS
)

TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()

INT_COLUMNS = [
    "vendor_id",
    "passenger_count",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
]
DOUBLE_COLUMNS = ["fare_amount", "tip_amount", "total_amount", "trip_distance"]
TIME_COLUMNS = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]

# What the large tables are partitioned by: the first day of the pickup's day, month, quarter or
# year. A day suits a table whose days fill files.
PICKUP_DATE = "pickup_date"
PARTITION_UNIT = "day"

# Key of the silver table.
SILVER_KEY = ["trip_id", "tpep_pickup_datetime"]

SILVER_COLUMNS = BRONZE_COLUMNS + [
    "pickup_zone",
    "pickup_borough",
    "pu_lat",
    "pu_lon",
    "dropoff_zone",
    "dropoff_borough",
    "do_lat",
    "do_lon",
    "pickup_h3",
    "dropoff_h3",
    "trip_duration_minutes",
    "fare_per_mile",
]

# Zone lookup file: header names as delivered, every value a string.
ZONE_FILE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType(), True)
        for name in ("LocationID", "Zone", "Borough", "lat", "lon")
    ]
)
