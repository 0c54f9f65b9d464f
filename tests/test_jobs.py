"""The commands, end to end on a local folder."""

import pytest
from test_tables import NOON, RAW

from tripmart.__main__ import main
from tripmart.session import build_session
from tripmart.sinks import published
from tripmart.sources import read_table

ZONES = "LocationID,Zone,Borough,lat,lon\n7,North,A,40.7,-74.0\n8,South,B,40.6,-74.1\n"


@pytest.fixture(params=["parquet", "orc"])
def table_format(request):
    return request.param


@pytest.fixture
def lake(spark, tmp_path):
    row = (2, NOON, NOON, 1.0, 2.5, 1.0, "N", 7, 8, 1) + (1.0,) * 7 + (2.5, 1.25)
    other = (1, NOON, NOON, 2.0, 0.0, 1.0, "N", 8, 7, 2) + (9.0,) * 7 + (2.5, 1.25)
    spark.createDataFrame([row, row, other], RAW).write.parquet(str(tmp_path / "raw"))
    (tmp_path / "zones.csv").write_text(ZONES)
    return tmp_path


def run(spark, lake, job, *options):
    return main([job, "--root", str(lake / "lake"), *options], spark)


def test_jobs_in_order(spark, lake, table_format):
    zones, raw = str(lake / "zones.csv"), str(lake / "raw")

    def run(spark, lake, job, *options):
        return main(
            [job, "--root", str(lake / "lake"), "--format", table_format, *options], spark
        )

    # Nothing there yet: silver and gold end quietly, the check does not.
    assert run(spark, lake, "silver", "--zones", zones) == 0
    assert run(spark, lake, "gold") == 0
    assert run(spark, lake, "dq") == 1

    assert run(spark, lake, "bronze", "--history", raw) == 0
    assert run(spark, lake, "silver", "--zones", zones) == 0
    assert run(spark, lake, "dq") == 0
    assert run(spark, lake, "gold", "--incremental") == 0
    assert run(spark, lake, "compact", "silver/trips", "--by", "tpep_pickup_datetime") == 0
    assert read_table(spark, str(lake / "lake/silver/trips"), table_format).count() == 2
    fact = read_table(spark, str(lake / "lake/gold/fact_trips"), table_format)
    assert {row["pickup_zone"] for row in fact.collect()} == {"North", "South"}


def test_gated_run_exit_code(spark, lake):
    zones, raw = str(lake / "zones.csv"), str(lake / "raw")
    assert run(spark, lake, "run", "--zones", zones, "--history", raw) == 0
    # A pickup without a position has no cell, which the gate refuses.
    (lake / "zones.csv").write_text(ZONES.replace("40.7", "0.0"))
    assert run(spark, lake, "run", "--zones", zones, "--history", raw) == 1
    fact = read_table(spark, str(lake / "lake/gold/fact_trips"))
    assert fact.filter("pickup_h3 is null").count() == 0


def test_session_modes(spark):
    with pytest.raises(ValueError):
        build_session("x", mode="moon")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_incremental_jobs_follow_bronze(spark, lake):
    zones, raw = str(lake / "zones.csv"), str(lake / "raw")
    path = str(lake / "lake/silver/trips")
    assert run(spark, lake, "bronze", "--history", raw) == 0
    for name in ("r1", "r2"):
        assert run(spark, lake, "silver", "--zones", zones, "--incremental", "--run-id", name) == 0
        assert run(spark, lake, "gold", "--incremental") == 0
        # nothing came since: the version stays
        assert published(spark, path) == "r1"
    assert read_table(spark, path).count() == 2
    assert read_table(spark, str(lake / "lake/gold/agg_daily_revenue")).count() == 2
