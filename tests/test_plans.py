"""What the physical plans must look like for the layers to scale."""

import re

import pytest
from test_clean import bronze, zones

from tripmart.plans import daily_revenue, hourly_demand, silver_trips, star_revenue
from tripmart.plans.gold import dim_payment, dim_zone, fact_trips
from tripmart.sinks import overwrite
from tripmart.sources import read_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    # Show scans in full.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    root = str(tmp_path_factory.mktemp("plans"))
    overwrite(bronze(spark, {}, {"trip_id": "b"}), f"{root}/bronze", "1")
    raw = read_table(spark, f"{root}/bronze")
    overwrite(silver_trips(raw, zones(spark)), f"{root}/silver", "1")
    return raw, read_table(spark, f"{root}/silver")


def scanned(plan):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)))


def test_silver_moves_trips_once(spark, tables):
    raw, _ = tables
    plan = plan_of(silver_trips(raw, zones(spark)))
    keyed = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert keyed.count("tpep_pickup_datetime") == 1
    assert set(keyed) == {"tpep_pickup_datetime", "LocationID"}
    assert plan.count("BroadcastHashJoin") == 2
    assert "Python" not in plan


def test_fare_filter_reaches_the_scan(spark, tables):
    raw, _ = tables
    assert "GreaterThanOrEqual(fare_amount,0.0)" in plan_of(silver_trips(raw, zones(spark)))


def test_aggregates_read_only_their_columns(tables):
    _, silver = tables
    assert scanned(plan_of(daily_revenue(silver))) == {
        "trip_id", "vendor_id", "tpep_pickup_datetime", "total_amount", "fare_amount",
        "trip_distance",
    }
    assert scanned(plan_of(hourly_demand(silver))) == {
        "trip_id", "tpep_pickup_datetime", "pickup_h3", "pickup_zone", "fare_amount",
        "trip_duration_minutes",
    }
    assert scanned(plan_of(dim_payment(silver))) == {"payment_type"}


def test_aggregates_hash_and_combine_before_they_move_rows(tables):
    _, silver = tables
    for df in (daily_revenue(silver), hourly_demand(silver), dim_payment(silver)):
        plan = plan_of(df)
        assert "SortAggregate" not in plan
        first, last = plan.index("HashAggregate"), plan.rindex("HashAggregate")
        assert first < plan.index("Exchange hashpartitioning") < last


def test_star_sums_before_it_joins(tables):
    _, silver = tables
    plan = plan_of(star_revenue(fact_trips(silver), dim_payment(silver), dim_zone(silver)))
    lines = plan.splitlines()
    deepest_join = max(i for i, line in enumerate(lines) if "Join" in line)
    partial = [i for i, line in enumerate(lines) if "partial_count(trip_id" in line]
    assert partial and min(partial) > min(i for i, line in enumerate(lines) if "Join" in line)
    assert any(i > deepest_join for i in partial)
