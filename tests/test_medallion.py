"""The gated run over all layers."""

import pytest
from pyspark.sql import functions as F
from test_clean import bronze, zones

from tripmart.__main__ import main
from tripmart.functions.lineage import add_lineage
from tripmart.operators import QualityError
from tripmart.plans import LakeConfig, run_gold, run_pipeline
from tripmart.plans.bronze import read_bronze, run_bronze
from tripmart.plans.silver import clean_trips
from tripmart.schemas import TRIP_COLUMNS
from tripmart.sinks import append_merge, published
from tripmart.sources import read_table

TABLES = ["fact_trips", "agg_daily_revenue", "agg_hourly_demand", "dim_payment", "dim_zone"]


def good_zones(spark):
    return zones(spark).withColumn("lat", F.lit(40.7))


def test_all_layers(spark, tmp_path):
    cfg = LakeConfig(
        root=str(tmp_path), zones=good_zones(spark), bronze=bronze(spark, {}, {"trip_id": "b"})
    )
    written = run_pipeline(spark, cfg, "r1")
    assert list(written) == TABLES
    assert read_table(spark, cfg.silver_path).count() == 2
    assert read_table(spark, written["fact_trips"]).count() == 2
    daily = read_table(spark, written["agg_daily_revenue"]).collect()
    assert [tuple(row)[:3] for row in daily] == [("2024-01-01", 1, 2)]
    assert read_table(spark, written["dim_zone"]).count() == 2


def test_failed_audit_leaves_silver_and_gold_as_they_were(spark, tmp_path):
    cfg = LakeConfig(root=str(tmp_path), zones=good_zones(spark), bronze=bronze(spark, {}))
    written = run_pipeline(spark, cfg, "r1")
    cfg.bronze = bronze(spark, {}, {"trip_id": "rich", "fare_amount": 2000.0})
    with pytest.raises(QualityError):
        run_pipeline(spark, cfg, "r2")
    assert [row["trip_id"] for row in read_table(spark, cfg.silver_path).collect()] == ["a"]
    assert [row["trip_id"] for row in read_table(spark, written["fact_trips"]).collect()] == ["a"]


def test_rejected_first_run_leaves_nothing_to_read(spark, tmp_path):
    cfg = LakeConfig(
        root=str(tmp_path), zones=good_zones(spark), bronze=bronze(spark, {"fare_amount": 2000.0})
    )
    for run in ("r1", "r2"):
        with pytest.raises(QualityError):
            run_pipeline(spark, cfg, run)
    assert read_table(spark, cfg.silver_path, missing="none") is None
    assert main(["gold", "--root", str(tmp_path)], spark) == 0
    assert not (tmp_path / "gold").exists()


def test_empty_silver_is_refused(spark, tmp_path):
    cfg = LakeConfig(root=str(tmp_path), zones=good_zones(spark), bronze=bronze(spark, {}))
    written = run_pipeline(spark, cfg, "r1")
    cfg.bronze = bronze(spark, {"fare_amount": None})
    with pytest.raises(QualityError, match="row_count"):
        run_pipeline(spark, cfg, "r2")
    assert read_table(spark, written["fact_trips"]).count() == 1


def test_fact_has_one_row_per_trip_on_every_run(spark, tmp_path):
    from tripmart.plans import silver_trips

    later = {"tpep_pickup_datetime": "2024-01-01 10:00:01", "extra": 1.0}
    other = {"trip_id": "b", "tpep_pickup_datetime": "2024-02-01 10:00:00", "tpep_dropoff_datetime": "2024-02-01 10:10:00"}
    both = silver_trips(bronze(spark, {}, later, other), good_zones(spark))
    first = silver_trips(bronze(spark, {}, other), good_zones(spark))
    roots = [str(tmp_path / x) for x in "ab"]
    run_gold(spark, both, roots[0], "1", incremental=True)
    run_gold(spark, first.filter("trip_id = 'none'"), roots[1], "0", incremental=True)
    run_gold(spark, both, roots[1], "1", incremental=True)
    facts = [sorted(map(str, read_table(spark, f"{r}/fact_trips").collect())) for r in roots]
    assert facts[0] == facts[1] and len(facts[0]) == 2


def test_incremental_fact_writes_touched_dates_only(spark, tmp_path):
    from datetime import datetime

    from tripmart.plans import silver_trips

    days = [{"trip_id": f"t{d}", "tpep_pickup_datetime": f"2024-01-0{d} 10:00:00", "tpep_dropoff_datetime": f"2024-01-0{d} 10:10:00"} for d in (1, 2, 3)]
    root = str(tmp_path)
    run_gold(spark, silver_trips(bronze(spark, *days), good_zones(spark)), root, "1", incremental=True)
    moved = {**days[0], "trip_id": "t2", "_ingest_ts": datetime(2024, 1, 9)}
    silver = silver_trips(bronze(spark, *days, moved), good_zones(spark))
    run_gold(spark, silver, root, "2", incremental=True)
    fact = read_table(spark, f"{root}/fact_trips")
    got = {(r["trip_id"], str(r["pickup_date"])) for r in fact.collect()}
    assert got == {("t1", "2024-01-01"), ("t2", "2024-01-01"), ("t3", "2024-01-03")}
    assert [n.name for n in (tmp_path / "fact_trips" / "v=2").iterdir() if "=" in n.name] == ["pickup_date=2024-01-01"]
    plan = fact.filter("pickup_date = '2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    run_gold(spark, silver, root, "3", incremental=True)
    assert not [n for n in (tmp_path / "fact_trips" / "v=3").iterdir() if "=" in n.name]
    assert {(r["trip_id"], str(r["pickup_date"])) for r in read_table(spark, f"{root}/fact_trips").collect()} == got


def test_bronze_reruns_change_nothing(spark, tmp_path):
    raw = str(tmp_path / "raw")
    bronze(spark, {}, {"trip_id": "b", "fare_amount": None}).drop("kafka_ts", "_ingest_ts", "record_source").withColumn(
        "fare_amount", F.col("fare_amount").cast("string")
    ).withColumn("colour", F.lit("red")).write.parquet(raw)
    path = str(tmp_path / "bronze")
    seeded = run_bronze(spark, path, raw)
    assert {r["colour"] for r in seeded.collect()} == {"red"}
    assert {r["trip_id"]: r["fare_amount"] for r in seeded.collect()} == {"a": 10.0, "b": None}
    live = add_lineage(seeded.select(*TRIP_COLUMNS).withColumn("fare_amount", F.lit(12.0)), "kafka_live")
    append_merge(live, path, "live", "0")
    before = sorted(map(str, read_bronze(spark, path).collect()))
    again = run_bronze(spark, path, raw)
    assert sorted(map(str, again.collect())) == before
    silver = clean_trips(again).collect()
    assert {r["trip_id"]: r["fare_amount"] for r in silver} == {"a": 12.0, "b": 12.0}


def test_rerun_gives_the_same_tables(spark, tmp_path):
    cfg = LakeConfig(root=str(tmp_path), zones=good_zones(spark), bronze=bronze(spark, {}, {}))
    written = run_pipeline(spark, cfg)
    before = {name: sorted(map(str, read_table(spark, p).collect())) for name, p in written.items()}
    written = run_pipeline(spark, cfg)
    after = {name: sorted(map(str, read_table(spark, p).collect())) for name, p in written.items()}
    assert before == after


def test_no_bronze_yet(spark, tmp_path):
    cfg = LakeConfig(root=str(tmp_path), zones=good_zones(spark))
    assert run_pipeline(spark, cfg) is None


def test_incremental_fact(spark, tmp_path):
    from datetime import datetime

    from tripmart.plans import silver_trips

    def silver(*changes):
        return silver_trips(bronze(spark, *changes), good_zones(spark))

    root = str(tmp_path)
    old = [{}, {"trip_id": "b"}]
    run_gold(spark, silver(*old), root, "1", incremental=True)
    new = {"fare_amount": 11.0, "_ingest_ts": datetime(2024, 1, 5)}
    # "b" is gone from silver; an incremental fact keeps what it has.
    run_gold(spark, silver({}, new), root, "2", incremental=True)
    fact = {r["trip_id"]: r["fare_amount"] for r in read_table(spark, f"{root}/fact_trips").collect()}
    assert fact == {"a": 11.0, "b": 10.0}
    run_gold(spark, silver({}, new), root, "3")
    assert read_table(spark, f"{root}/fact_trips").count() == 1


def test_one_failed_table_publishes_none(spark, tmp_path):
    from tripmart.plans import silver_trips

    root = str(tmp_path)
    silver = silver_trips(bronze(spark, {}), good_zones(spark))
    run_gold(spark, silver, root, "1")
    broken = silver.withColumn("payment_type", F.expr("int(raise_error('broken'))"))
    with pytest.raises(Exception, match="broken"):
        run_gold(spark, broken.union(silver), root, "2")
    for name in TABLES:
        assert read_table(spark, f"{root}/{name}").count() > 0
        assert published(spark, f"{root}/{name}") == "1"
