"""Cells and lookup joins."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tripmart.functions.cells import (
    AXIS_OFFSET,
    AXIS_SPAN,
    METRES_PER_LAT,
    METRES_PER_LON,
    edge_metres,
    hex_cell,
)
from tripmart.operators import lookup
from tripmart.operators.zones import enrich_zones

POINTS = "lat double, lon double"


def centre(cell: str, res: int) -> tuple[float, float]:
    packed = int(cell, 16) - res * AXIS_SPAN * AXIS_SPAN
    q = packed // AXIS_SPAN - AXIS_OFFSET
    r = packed % AXIS_SPAN - AXIS_OFFSET
    edge = edge_metres(res)
    return edge * math.sqrt(3) * (q + r / 2), 1.5 * edge * r


@pytest.mark.parametrize("res", [0, 7, 9, 12, 15])
def test_point_lies_in_its_cell(spark, res):
    rng = random.Random(7)
    points = [(rng.uniform(40.4, 41.0), rng.uniform(-74.3, -73.6)) for _ in range(2000)]
    df = spark.createDataFrame(points, POINTS)
    for row in df.withColumn("cell", hex_cell(F.col("lat"), F.col("lon"), res)).collect():
        assert len(row["cell"]) == 15 and set(row["cell"]) <= set("0123456789abcdef")
        east, north = centre(row["cell"], res)
        distance = math.hypot(
            row["lon"] * METRES_PER_LON - east, row["lat"] * METRES_PER_LAT - north
        )
        assert distance <= edge_metres(res) * (1 + 1e-9)


def test_missing_positions_have_no_cell(spark):
    nan, inf = float("nan"), float("inf")
    points = [
        (None, -74.0),
        (40.7, None),
        (0.0, -74.0),
        (40.7, 0.0),
        (nan, -74.0),
        (40.7, inf),
        (91.0, -74.0),
        (40.7, -181.0),
        (1e300, 1e300),
    ]
    df = spark.createDataFrame(points, POINTS).select(hex_cell(F.col("lat"), F.col("lon")))
    assert [row[0] for row in df.collect()] == [None] * len(points)


def test_text_positions(spark):
    df = spark.createDataFrame([("40.7", "-74.0"), ("x", "-74.0")], "lat string, lon string")
    first, second = df.select(hex_cell(F.col("lat"), F.col("lon"))).collect()
    assert first[0] is not None and second[0] is None


def test_bad_resolution():
    with pytest.raises(ValueError):
        hex_cell(F.lit(1.0), F.lit(1.0), 16)


def lookup_frames(spark):
    trips = spark.range(3000).selectExpr(
        "cast(id as string) as trip_id",
        "cast(case when id % 3 = 0 then 1 when id % 3 = 1 then id % 50 end as int) as zone",
    )
    zones = spark.range(40).selectExpr("cast(id as int) as zone", "concat('z', id) as name")
    return trips, zones


def test_large_lookup_gives_the_same_rows_as_a_small_one(spark):
    trips, zones = lookup_frames(spark)
    small = lookup.lookup_join(trips, zones, "zone", ["trip_id"], small=True)
    large = lookup.lookup_join(trips, zones, "zone", ["trip_id"], small=False)
    assert sorted(map(str, large.select(small.columns).collect())) == sorted(
        map(str, small.collect())
    )
    assert large.count() == 3000
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in large.columns


def test_fits_broadcast_measures_rows_and_bytes(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) as text")
    assert lookup.fits_broadcast(df)
    assert not lookup.fits_broadcast(df, max_rows=99)
    assert lookup.fits_broadcast(df, max_rows=100)
    assert not lookup.fits_broadcast(df, max_bytes=100_000)
    assert lookup.fits_broadcast(df.limit(0), max_rows=0)
    nested = spark.range(10).selectExpr("array_repeat(repeat('x', 1000), 10) as texts")
    assert not lookup.fits_broadcast(nested, max_bytes=90_000)


def test_enrich_without_broadcast(spark, monkeypatch):
    trips = spark.createDataFrame(
        [("a", "t", 1, 2), ("b", "t", 2, 9), ("c", "t", None, 1)],
        "trip_id string, tpep_pickup_datetime string, PULocationID int, DOLocationID int",
    )
    zones = spark.createDataFrame(
        [(1, "N", "A", 40.7, -74.0), (2, "S", "B", 40.6, -74.1)],
        "LocationID int, zone_name string, borough string, lat double, lon double",
    )
    broadcast = enrich_zones(trips, zones)
    monkeypatch.setattr("tripmart.operators.zones.fits_broadcast", lambda df: False)
    shuffled = enrich_zones(trips, zones).select(broadcast.columns)
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, broadcast.collect()))


def test_own_cell_column(spark):
    trips = spark.createDataFrame(
        [("a", "t", 1, 1)],
        "trip_id string, tpep_pickup_datetime string, PULocationID int, DOLocationID int",
    )
    zones = spark.createDataFrame(
        [(1, "N", "A", 40.7, -74.0, "892a1072b5bffff")],
        "LocationID int, zone_name string, borough string, lat double, lon double, index string",
    )
    row = enrich_zones(trips, zones, cell_col="index").first()
    assert row["pickup_h3"] == row["dropoff_h3"] == "892a1072b5bffff"


def test_hot_keys_are_salted_by_their_count(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 0, if(id % 50 = 1, null, id % 7)) as k")
    zones = spark.range(5).selectExpr("id as k", "id * 10 as v")
    plain = lookup.lookup_join(df, zones, "k", ["id"], small=True)
    salted = lookup.lookup_join(df, zones, "k", ["id"], small=False, rows_per_task=100)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.select(*salted.columns).collect()))
