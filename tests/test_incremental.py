"""Aggregates and silver that follow what changed, and files whose columns changed."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_clean import bronze, zones
from test_medallion import good_zones

from tripmart.plans import LakeConfig, daily_revenue, demand_heatmap, hourly_demand, run_pipeline, silver_trips
from tripmart.plans import rollups
from tripmart.plans.bronze import read_bronze
from tripmart.plans.silver import refresh_silver
from tripmart.schemas import PICKUP_DATE, SILVER_COLUMNS
from tripmart.sinks import append_merge, compact, compact_origin, overwrite
from tripmart.sinks import tables as sinks
from tripmart.functions.widening import wider, widened
from tripmart.sinks.drift import scan_drifting
from tripmart.sources import read_table, scan_history

RES = {"fare_amount": 100, "total_amount": 100, "trip_distance": 10, "trip_duration_minutes": 60}
DIRECT = {"agg_daily_revenue": daily_revenue, "agg_hourly_demand": hourly_demand, "agg_demand_heatmap": demand_heatmap}


def bag(df):
    return sorted(map(str, df.collect()))


def trip(key, day, **changed):
    at = f"2024-01-{day:02}"
    return {
        "trip_id": key,
        "tpep_pickup_datetime": f"{at} 10:00:00",
        "tpep_dropoff_datetime": f"{at} 10:12:00",
    } | changed


def spoil(folder):
    """Make a partition unreadable; who reads it fails."""
    found = glob.glob(f"{folder}/part-*")
    assert found
    for file in found:
        with open(file, "wb") as f:
            f.write(b"no parquet")
        crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def dated(spark, *rows):
    silver = silver_trips(bronze(spark, *rows), good_zones(spark))
    return silver.withColumn(PICKUP_DATE, F.to_date("tpep_pickup_datetime"))


@pytest.mark.parametrize("rollup", rollups.ROLLUPS, ids=lambda r: r.name)
@pytest.mark.parametrize("resolutions", [None, RES])
def test_states_add_up_to_the_aggregate(spark, rollup, resolutions):
    rows = dated(
        spark, trip("a", 1), trip("b", 1, fare_amount=7.5), trip("c", 2, PULocationID=99), trip("d", 3, trip_distance=None)
    )
    states = rollups.states_of(rollup, rows, resolutions)
    whole = DIRECT[rollup.name](rows, resolutions)
    found = rollups.merged(rollup, states.unionByName(states.limit(0)), resolutions)
    assert found.dtypes == whole.dtypes and bag(found) == bag(whole)


@pytest.mark.parametrize("rollup", rollups.ROLLUPS, ids=lambda r: r.name)
def test_refresh_reads_touched_partitions_only(spark, tmp_path, rollup):
    fact, states = str(tmp_path / "fact"), str(tmp_path / "states")
    overwrite(dated(spark, trip("a", 1), trip("b", 2), trip("c", 3)), fact, "1", partition_by=[PICKUP_DATE])
    assert rollups.refresh(spark, rollup, fact, states, "1", resolutions=RES) is None

    # one trip changes on the 2nd, the 3rd loses its only one, the 4th is new
    new = dated(spark, trip("b", 2, fare_amount=20.0), trip("d", 4))
    touched = [d for d, in spark.sql("select explode(sequence(date'2024-01-02', date'2024-01-04'))").collect()]
    sinks.replace_partitions(new, fact, "2", PICKUP_DATE, touched)
    expected = bag(DIRECT[rollup.name](read_table(spark, fact), RES))
    spoil(f"{fact}/v=1/{PICKUP_DATE}=2024-01-01")
    parts = rollups.refresh(spark, rollup, fact, states, "2", touched, "1", RES)
    assert parts == {f"{PICKUP_DATE}=2024-01-0{d}": v for d, v in ((1, "1"), (2, "2"), (4, "2"))}
    assert bag(rollups.merged(rollup, read_table(spark, states), RES)) == expected

    # states that stand at the published version stay as they are
    assert rollups.refresh(spark, rollup, fact, states, "3", touched, "1", RES) == parts
    # states of another version do not follow: all of the fact is read
    sinks.replace_partitions(dated(spark, trip("e", 4)), fact, "4", PICKUP_DATE, touched[2:])
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        rollups.refresh(spark, rollup, fact, states, "4", touched[2:], "another", RES)


def arrive(spark, path, origin, name, *rows):
    append_merge(bronze(spark, *rows), path, origin, name)


def stamped(row, seconds):
    return row | {"_ingest_ts": datetime(2024, 3, 1, 0, 0, seconds)}


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_silver_follows_bronze(spark, tmp_path, max_rows):
    lake, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def refresh(run, places=None):
        change = refresh_silver(spark, lake, places or good_zones(spark), silver, run, max_rows=max_rows)
        if change is not None:
            change.publish(spark, silver)
        return change

    def same():
        expected = silver_trips(read_bronze(spark, lake), good_zones(spark))
        return bag(read_table(spark, silver).select(*SILVER_COLUMNS)) == bag(expected)

    assert refresh("0") is None
    arrive(spark, lake, "seed", "0", stamped(trip("a", 1), 5), stamped(trip("b", 2), 5), stamped(trip("c", 3), 5))
    assert refresh("1").touched is None and same()
    # a correction, a correction that moves a trip, a new trip, an invalid row, one without an id
    arrive(
        spark, lake, "live", "0", stamped(trip("b", 2, fare_amount=9.0), 6), stamped(trip("c", 5), 6),
        stamped(trip("d", 5), 6), stamped(trip("a", 1, fare_amount=-1.0), 9), stamped(trip(None, 2), 6),
    )
    kept = sinks.current_parts(spark, silver)
    change = refresh("2")
    assert sorted(map(str, change.touched)) == ["2024-01-02", "2024-01-05"] and same()
    parts = sinks.current_parts(spark, silver)
    assert {k: v for k, v in parts.items() if v == "1"} == {
        k: v for k, v in kept.items() if not k.endswith("-02")
    }
    # late rows lose, rows that repeat a batch change nothing
    arrive(spark, lake, "live", "1", stamped(trip("b", 2, fare_amount=1.0), 1), stamped(trip("e", 4), 1))
    refresh("3")
    assert same()
    assert refresh("4").run_id == "3"
    # compaction puts batches together that are known, and later one that is not
    compact_origin(spark, lake, "live", "c1")
    assert refresh("5").run_id == "3"
    arrive(spark, lake, "live", "2", stamped(trip("e", 4, extra=3.0), 8))
    compact_origin(spark, lake, "live", "c2")
    assert refresh("6").touched and same()
    # a compacted silver goes on where it was
    compact(spark, silver, "7", ["tpep_pickup_datetime"])
    assert refresh("8").run_id == "7"
    arrive(spark, lake, "live", "3", stamped(trip("f", 1), 8))
    assert [str(t) for t in refresh("9").touched] == ["2024-01-01"] and same()
    # other zones concern every row
    assert refresh("10", zones(spark)).touched is None


def test_silver_leaves_untouched_partitions_unread(spark, tmp_path):
    lake, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    arrive(spark, lake, "seed", "0", stamped(trip("a", 1), 5), stamped(trip("b", 2), 5))
    for run in ("1", "2"):
        refresh_silver(spark, lake, good_zones(spark), silver, run).publish(spark, silver)
        spoil(f"{silver}/v=1/{PICKUP_DATE}=2024-01-01") if run == "1" else None
        arrive(spark, lake, "live", run, stamped(trip("b", 2, extra=2.0), 7))
    assert sinks.current_parts(spark, silver)[f"{PICKUP_DATE}=2024-01-02"] == "2"


def test_incremental_runs_follow_a_growing_lake(spark, tmp_path):
    cfg = LakeConfig(root=str(tmp_path), zones=good_zones(spark), incremental=True, resolutions=RES)
    whole = LakeConfig(root=str(tmp_path / "whole"), zones=good_zones(spark), resolutions=RES)
    arrive(spark, cfg.bronze_path, "seed", "0", stamped(trip("a", 1), 5), stamped(trip("b", 2), 5))
    run_pipeline(spark, cfg, "1")
    arrive(spark, cfg.bronze_path, "live", "0", stamped(trip("b", 2, fare_amount=9.0), 6), stamped(trip("c", 3), 6))
    for run in ("2", "3"):  # the third has nothing to do
        written = run_pipeline(spark, cfg, run)
        whole.bronze = read_bronze(spark, cfg.bronze_path)
        expected = run_pipeline(spark, whole, run)
        for name in written:
            assert bag(read_table(spark, written[name])) == bag(read_table(spark, expected[name])), name
    states = sinks.current_parts(spark, f"{cfg.gold_path}/_states/agg_daily_revenue")
    assert states[f"{PICKUP_DATE}=2024-01-01"] == "1" and states[f"{PICKUP_DATE}=2024-01-02"] == "2"


def test_ladder_of_types():
    i, n, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert [wider(i, n), wider(n, i), wider(n, d), wider(d, s), wider(i, i)] == [n, n, d, s, i]
    assert wider(T.FloatType(), i) == d and wider(T.FloatType(), T.ShortType()) == T.FloatType()
    assert wider(T.DecimalType(5, 2), T.DecimalType(6, 1)) == T.DecimalType(7, 2)
    assert wider(T.DateType(), T.TimestampType()) == T.TimestampType() and wider(T.DateType(), i) == s
    assert wider(T.ArrayType(i), T.ArrayType(s)) == T.ArrayType(s) and wider(T.ArrayType(i), s) == s
    nested = wider(T.StructType([T.StructField("x", i)]), T.StructType([T.StructField("X", n), T.StructField("y", s)]))
    assert nested.simpleString() == "struct<x:bigint,y:string>"
    assert widened([T.StructType([T.StructField("A", i)]), T.StructType([T.StructField("a", s)])]).names == ["A"]


def test_history_whose_columns_drift(spark, tmp_path):
    path = f"{tmp_path}/my files"
    spark.sql("select 1 as trip_id, 1 as n, 1.5d as Airport_fee, named_struct('x', 1) as s").write.parquet(f"{path}/year=2020")
    spark.sql("select 2L as trip_id, 9999999999L as n, 2 as airport_fee, 'b' as b").write.parquet(f"{path}/year=2021")
    spark.sql("select 'c' as trip_id, 'n/a' as n, named_struct('x', 'q', 'y', 2) as s").write.parquet(f"{path}/year=2022")
    found = scan_history(spark, path)
    assert dict(found.dtypes) == {
        "trip_id": "string", "n": "string", "Airport_fee": "double", "b": "string", "s": "struct<x:string,y:int>", "year": "int",
    }
    rows = {r.trip_id: r.asDict(recursive=True) for r in found.collect()}
    assert rows["1"] == {"trip_id": "1", "n": "1", "Airport_fee": 1.5, "b": None, "s": {"x": "1", "y": None}, "year": 2020}
    assert (rows["2"]["n"], rows["2"]["Airport_fee"], rows["2"]["s"], rows["2"]["b"]) == ("9999999999", 2.0, None, "b")
    assert rows["c"]["s"] == {"x": "q", "y": 2} and rows["c"]["Airport_fee"] is None
    # a column and a filter reach every scan
    plan = found.where("b = 'b'").select("n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 3 and "airport" not in plan.lower().replace("location", "").split("readschema")[-1]
    assert scan_drifting(spark, f"{path}/year=2020").columns == ["trip_id", "n", "Airport_fee", "s"]


def test_one_scan_per_schema(spark, tmp_path):
    path = str(tmp_path / "files")
    for k in range(6):
        columns = ["id", "id + 1 as a"] if k % 2 else ["id", "cast(id as int) as a", "'x' as x"]
        spark.range(k + 1).selectExpr(*columns).coalesce(1).write.mode("append").parquet(path)
    found = scan_drifting(spark, path)
    assert found.count() == 21 and dict(found.dtypes)["a"] == "bigint" and found.where("x is null").count() == 12
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2


def test_bronze_of_batches_whose_columns_drift(spark, tmp_path):
    path = str(tmp_path / "bronze")
    first = bronze(spark, stamped(trip("a", 1), 1))
    append_merge(first.withColumn("fare_amount", F.lit(7)), path, "seed", "0")
    append_merge(first.withColumn("fare_amount", F.lit("n/a")).withColumn("note", F.lit("x")), path, "seed", "1")
    append_merge(first.withColumn("trip_id", F.lit("l")), path, "live", "0")
    found = read_bronze(spark, path).orderBy("trip_id", "note").collect()
    assert [(r.trip_id, r.fare_amount, r.note) for r in found] == [("a", 7.0, None), ("a", None, "x"), ("l", first.first().fare_amount, None)]
    compact_origin(spark, path, "seed", "c")
    again = read_bronze(spark, path).orderBy("trip_id", "note").collect()
    assert [(r.trip_id, r.fare_amount, r.note) for r in again] == [(r.trip_id, r.fare_amount, r.note) for r in found]
