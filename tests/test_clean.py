"""Typing, filters, metrics and dedupe on hand-made rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmart.operators import latest_per_key, trip_metrics, type_trips, valid_trips
from tripmart.plans.silver import clean_trips, silver_trips
from tripmart.schemas import BRONZE_SCHEMA, SILVER_COLUMNS, SILVER_KEY

TRIP = {
    "trip_id": "a",
    "vendor_id": 1,
    "tpep_pickup_datetime": "2024-01-01 10:00:00",
    "tpep_dropoff_datetime": "2024-01-01 10:30:00",
    "passenger_count": 1,
    "trip_distance": 2.0,
    "RatecodeID": None,
    "store_and_fwd_flag": None,
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 11.8,
    "congestion_surcharge": None,
    "airport_fee": None,
    "kafka_ts": None,
    "_ingest_ts": datetime(2024, 1, 2),
    "record_source": "kafka_live",
}


def bronze(spark, *changes):
    rows = [tuple({**TRIP, **change}[f.name] for f in BRONZE_SCHEMA) for change in changes]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def zones(spark, *extra):
    rows = [(1, "North", "A", 40.7, -74.0), (2, "South", "B", 0.0, -74.0), *extra]
    return spark.createDataFrame(
        rows, "LocationID int, zone_name string, borough string, lat double, lon double"
    )


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_bad_text_becomes_null(spark, ansi):
    names = ["vendor_id", "passenger_count", "RatecodeID", "PULocationID", "DOLocationID"]
    names += ["payment_type", "fare_amount", "tip_amount", "total_amount", "trip_distance"]
    names += ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
    rows = [
        ("1", " 2 ", "3.0", "x", "", "99999999999", "1.5", "x", None, "1e2", "bad", "2024-01-01"),
        ("-4", "+5", "-6.75", "1e3", "1.2.3", ".", "", "-1", "7", "0", "2024-01-01 01:02:03", None),
    ]
    typed = type_trips(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)))
    first, second = typed.select(names).collect()
    assert list(first)[:6] == [1, 2, 3, None, None, None]
    assert list(first)[6:10] == [1.5, None, None, 100.0]
    assert list(first)[10:] == [None, datetime(2024, 1, 1)]
    assert list(second)[:6] == [-4, 5, -6, None, None, None]
    assert list(second)[6:10] == [None, -1.0, 7.0, 0.0]
    assert list(second)[10:] == [datetime(2024, 1, 1, 1, 2, 3), None]


def test_not_a_number_code_becomes_null(spark, ansi):
    df = bronze(spark, {}).withColumn("passenger_count", F.lit(float("nan")))
    assert type_trips(df).first()["passenger_count"] is None
    df = bronze(spark, {}).withColumn("passenger_count", F.lit(2.9))
    assert type_trips(df).first()["passenger_count"] == 2


def test_metrics(spark):
    rows = [
        ("2024-01-01 10:00:00.9", "2024-01-01 10:01:30.1", 10.0, 4.0),
        ("2024-01-01 10:00:00", "2024-01-01 09:59:00", 10.0, 0.0),
        ("2024-01-01 10:00:00", None, None, -1.0),
    ]
    df = spark.createDataFrame(
        rows,
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, "
        "fare_amount double, trip_distance double",
    ).withColumns(
        {
            name: F.col(name).cast("timestamp")
            for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        }
    )
    got = [
        (row["trip_duration_minutes"], row["fare_per_mile"]) for row in trip_metrics(df).collect()
    ]
    # Fractions of a second are dropped from each end before the difference is taken.
    assert got == [(1.5, 2.5), (-1.0, None), (None, None)]


def test_filter_rejects_null_and_negative(spark):
    df = type_trips(
        bronze(
            spark,
            {"trip_id": "ok"},
            {"trip_id": "zero", "fare_amount": 0.0},
            {"trip_id": "null fare", "fare_amount": None},
            {"trip_id": "negative fare", "fare_amount": -0.01},
            {"trip_id": "backwards", "tpep_dropoff_datetime": "2024-01-01 09:59:59"},
            {"trip_id": "no dropoff", "tpep_dropoff_datetime": None},
            {"trip_id": "bad pickup", "tpep_pickup_datetime": "soon"},
        )
    )
    assert {row["trip_id"] for row in valid_trips(df).collect()} == {"ok", "zero"}


def test_latest_row_wins_and_ties_are_broken(spark):
    rows = [
        ("a", 1, "old"),
        ("a", 2, "new"),
        ("b", None, "null loses"),
        ("b", 0, "known"),
        ("c", 5, "x"),
        ("c", 5, "y"),
        (None, 1, "null key"),
        (None, 2, "null key, newer"),
    ]
    df = spark.createDataFrame(rows, "k string, v int, t string")
    got = {(row["k"], row["t"]) for row in latest_per_key(df, ["k"], "v", ["t"]).collect()}
    assert got == {("a", "new"), ("b", "known"), ("c", "y"), (None, "null key, newer")}


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    latest = latest_per_key(df, ["k"], "v")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    hot = latest.filter("k = 0").collect()
    assert [row["v"] for row in hot] == [999]
    assert latest.count() == 1 + 666


def test_older_valid_row_survives_a_broken_newer_one(spark):
    df = bronze(
        spark,
        {"total_amount": 1.0},
        {"total_amount": 2.0, "fare_amount": -1.0, "_ingest_ts": datetime(2024, 1, 3)},
    )
    assert [row["total_amount"] for row in clean_trips(df).collect()] == [1.0]


def test_same_batch_ties_are_deterministic(spark):
    changes = [{"total_amount": float(i)} for i in range(20)]
    forward = clean_trips(bronze(spark, *changes)).collect()
    backward = clean_trips(bronze(spark, *reversed(changes))).collect()
    assert forward == backward
    assert forward[0]["total_amount"] == 19.0


def test_silver_shape_and_idempotence(spark):
    df = bronze(
        spark,
        {},
        {"trip_id": "b", "PULocationID": 99},
        {"trip_id": "c", "trip_distance": 0.0, "DOLocationID": None},
    )
    silver = silver_trips(df, zones(spark))
    assert silver.columns == SILVER_COLUMNS
    assert len(silver.columns) == 35
    rows = {row["trip_id"]: row for row in silver.collect()}
    assert rows["a"]["pickup_zone"] == "North" and rows["a"]["pickup_h3"] is not None
    assert rows["a"]["dropoff_zone"] == "South" and rows["a"]["dropoff_h3"] is None
    assert rows["b"]["pickup_zone"] is None and rows["b"]["pickup_h3"] is None
    assert rows["c"]["fare_per_mile"] is None and rows["c"]["dropoff_zone"] is None

    again = silver_trips(df.unionByName(df), zones(spark))
    assert sorted(map(str, again.collect())) == sorted(map(str, silver.collect()))


def test_doubled_zone_does_not_double_trips(spark):
    doubled = zones(spark, (1, "Other name", "A", 40.8, -74.0), (None, "Nowhere", "A", 1.0, 1.0))
    silver = silver_trips(bronze(spark, {}), doubled)
    assert [row["pickup_zone"] for row in silver.collect()] == ["North"]


def test_missing_columns_are_null(spark):
    df = bronze(spark, {}).drop("kafka_ts", "airport_fee")
    row = silver_trips(df, zones(spark)).first()
    assert row["kafka_ts"] is None and row["airport_fee"] is None


def test_silver_key_is_unique(spark):
    df = bronze(spark, {}, {"tpep_pickup_datetime": "2024-01-01 10:00:01"}, {"extra": 3.0})
    silver = clean_trips(df)
    assert silver.count() == silver.select(*SILVER_KEY).distinct().count() == 2
