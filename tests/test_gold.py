"""Gold tables on hand-made silver rows."""

from datetime import datetime

import pytest

from tripmart.functions.totals import mean, total
from tripmart.plans import gold
from pyspark.sql import functions as F

SILVER = (
    "trip_id string, vendor_id int, tpep_pickup_datetime timestamp, PULocationID int, "
    "DOLocationID int, pickup_zone string, pickup_borough string, pickup_h3 string, "
    "dropoff_zone string, dropoff_borough string, dropoff_h3 string, payment_type int, "
    "fare_amount double, total_amount double, trip_distance double, trip_duration_minutes double"
)


@pytest.fixture(scope="module")
def silver(spark):
    early, late = datetime(2024, 1, 1, 9, 5), datetime(2024, 1, 1, 9, 55)
    north, south = ("N", "A", "9" * 15), ("S", "B", None)
    rows = [
        ("a", 1, early, 1, 2, *north, *south, 1, 10.1, 12.3, 1.0, 5.0),
        ("b", 1, late, 1, 1, *north, *north, 9, 20.2, 22.4, 3.0, 10.0),
        ("c", 2, datetime(2024, 1, 2), 2, 3, *south, None, None, None, None, None, 5.5, None, 1.0),
    ]
    return spark.createDataFrame(rows, SILVER)


def test_daily(silver):
    rows = [tuple(row) for row in gold.daily_revenue(silver).collect()]
    assert rows[0][:3] == ("2024-01-01", 1, 2)
    assert rows[0][3:] == pytest.approx((34.7, 15.15, 2.0))
    assert rows[1] == ("2024-01-02", 2, 1, 5.5, None, None)


def test_fixed_point_agrees_with_doubles(silver):
    res = {"fare_amount": 100, "total_amount": 100, "trip_distance": 10}
    plain = gold.daily_revenue(silver).collect()
    fixed = gold.daily_revenue(silver, res).collect()
    for one, other in zip(plain, fixed):
        assert tuple(one)[:3] == tuple(other)[:3]
        assert tuple(one)[3:] == pytest.approx(tuple(other)[3:])


def test_fixed_point_is_exact(spark):
    df = spark.range(0, 100_000, 1, 13).select((F.lit(0.1) + F.col("id") * 0).alias("x"))
    assert df.agg(total(F.col("x"), 10)).first()[0] == 10_000.0
    assert df.agg(mean(F.col("x"), 10)).first()[0] == 0.1
    negative = spark.createDataFrame([(-0.3,), (-0.1,), (None,)], "x double")
    assert negative.agg(total(F.col("x"), 10), mean(F.col("x"), 10)).first() == (-0.4, -0.2)
    assert negative.filter("x is null").agg(mean(F.col("x"), 10)).first()[0] is None


def test_hourly(silver):
    rows = [tuple(row) for row in gold.hourly_demand(silver).collect()]
    assert rows[0][:4] == ("2024-01-01 09:00:00", "9" * 15, "N", 2)
    assert rows[0][4:] == pytest.approx((15.15, 7.5))
    # A trip without a cell is in a group of its own.
    assert rows[1] == ("2024-01-02 00:00:00", None, "S", 1, None, 1.0)


def test_heatmap(silver):
    counts = {row["pickup_h3"]: row["trip_count"] for row in gold.demand_heatmap(silver).collect()}
    assert counts == {"9" * 15: 2, None: 1}


def test_time_labels_follow_the_session_zone(spark, silver):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hours = [row["pickup_hour"] for row in gold.hourly_demand(silver).collect()]
        days = [row["trip_date"] for row in gold.daily_revenue(silver).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert hours == ["2024-01-01 04:00:00", "2024-01-01 19:00:00"]
    assert days == ["2024-01-01", "2024-01-01"]


def test_repeated_hour_at_the_end_of_summer_time_is_one_hour(spark):
    # 05:30 and 06:30 UTC are both 01:30 in New York on that night.
    df = spark.createDataFrame(
        [("a", datetime(2024, 11, 3, 5, 30)), ("b", datetime(2024, 11, 3, 6, 30))],
        "trip_id string, tpep_pickup_datetime timestamp",
    ).selectExpr(
        "*", "'c' as pickup_h3", "'z' as pickup_zone", "1d as fare_amount",
        "1d as trip_duration_minutes",
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(row["pickup_hour"], row["trip_count"]) for row in gold.hourly_demand(df).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == [("2024-11-03 01:00:00", 2)]


def test_payment_labels(silver):
    labels = {row[0]: row[1] for row in gold.dim_payment(silver).collect()}
    assert labels == {1: "Credit card", 9: "Other", None: "Other"}


def test_zones_of_both_ends(silver):
    rows = [tuple(row) for row in gold.dim_zone(silver).collect()]
    assert rows == [(1, "N", "A", "9" * 15), (2, "S", "B", None), (3, None, None, None)]
    assert gold.zone_tuples(silver).count() == 3


def test_conflicting_zone_attributes_give_one_row(spark):
    rows = [("b", 1, None, None), ("a", 1, "Y", "h"), ("a", 1, None, "h")]
    df = spark.createDataFrame(
        rows,
        "pickup_zone string, PULocationID int, pickup_borough string, pickup_h3 string",
    ).selectExpr(
        "*", "PULocationID as DOLocationID", "pickup_zone as dropoff_zone",
        "pickup_borough as dropoff_borough", "pickup_h3 as dropoff_h3",
    )
    assert [tuple(row) for row in gold.dim_zone(df).collect()] == [(1, "a", "Y", "h")]
    assert gold.zone_tuples(df).count() == 3


def test_star(silver):
    fact = silver.withColumnsRenamed(gold.FACT_NAMES)
    payment, zone = gold.dim_payment(silver), gold.dim_zone(silver)
    for res in (None, {"total_amount": 100}):
        rows = {
            tuple(row)[:3]: tuple(row)[3:]
            for row in gold.star_revenue(fact, payment, zone, res).collect()
        }
        assert rows[("A", "B", "Credit card")] == (1, 12.3)
        assert rows[("A", "A", "Other")] == (1, 22.4)
        # A NULL code finds no dimension row.
        assert rows[("B", None, None)] == (1, 5.5)


def test_fact_names(spark):
    df = spark.createDataFrame([tuple(["x"] * 22)], ", ".join(f"{n} string" for n in gold.FACT_COLUMNS))
    assert gold.fact_trips(df, rename=False).columns == gold.FACT_COLUMNS
    renamed = gold.fact_trips(df).columns
    assert {"rate_code_id", "pickup_location_id", "dropoff_location_id"} <= set(renamed)
    assert len(renamed) == 22
