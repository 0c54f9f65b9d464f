"""Checks, the gate, and referential integrity."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmart.operators import Check, QualityError, evaluate, gate, orphans, orphans_of
from tripmart.operators.checks import REPORT_COLUMNS, verdict
from tripmart.plans import run_dq, silver_suite, table_suite

CELL = "892a1072b5bffff"
COLUMNS = (
    "trip_id string, vendor_id int, tpep_pickup_datetime timestamp, pickup_h3 string, "
    "passenger_count int, fare_amount double, trip_duration_minutes double"
)
GOOD = ("a", 1, datetime(2024, 1, 1), CELL, 1, 10.0, 5.0)


def silver(spark, *changes):
    names = [part.split()[0] for part in COLUMNS.split(", ")]
    rows = [tuple({**dict(zip(names, GOOD)), **change}.values()) for change in changes]
    return spark.createDataFrame(rows, COLUMNS)


def outcome(df, suite):
    report = evaluate(df, suite)
    assert report.columns == REPORT_COLUMNS
    return {
        (row["check_name"], row["column_name"]): (row["unexpected_count"], row["success"])
        for row in report.collect()
    }


def test_good_silver_passes_both_suites(spark):
    df = silver(spark, {}, {"trip_id": "b"})
    assert len(run_dq(df)) == len(silver_suite()) == 10
    assert len(run_dq(df, table_suite())) == len(table_suite()) == 8


@pytest.mark.parametrize(
    "change, failed",
    [
        ({"tpep_pickup_datetime": None}, ("not_null", "tpep_pickup_datetime")),
        ({"pickup_h3": None}, ("not_null", "pickup_h3")),
        ({"pickup_h3": CELL.upper()}, ("regex", "pickup_h3")),
        ({"pickup_h3": CELL + "0"}, ("regex", "pickup_h3")),
        ({"passenger_count": 11}, ("between", "passenger_count")),
        ({"fare_amount": 1000.01}, ("between", "fare_amount")),
        ({"fare_amount": -0.01}, ("between", "fare_amount")),
        ({"trip_duration_minutes": 360.5}, ("between", "trip_duration_minutes")),
        ({"trip_id": "a"}, ("unique", "trip_id,tpep_pickup_datetime")),
    ],
)
def test_broken_silver_fails_one_check(spark, change, failed):
    df = silver(spark, {}, {"trip_id": "b", **change})
    bad = {key for key, (_, success) in outcome(df, silver_suite()).items() if not success}
    assert bad == {failed}
    with pytest.raises(QualityError) as error:
        run_dq(df)
    assert [(f["check_name"], f["column_name"]) for f in error.value.failures] == [failed]


def test_limits_are_inclusive_and_null_passes_ranges(spark):
    df = silver(
        spark,
        {"passenger_count": 0, "fare_amount": 0.0, "trip_duration_minutes": 0.0},
        {"trip_id": "b", "passenger_count": 10, "fare_amount": 1000.0},
        {"trip_id": "c", "passenger_count": None, "fare_amount": None},
        {"trip_id": "d", "trip_duration_minutes": 360.0},
    )
    assert all(success for _, success in outcome(df, silver_suite()).values())


def test_unique_counts_all_rows_and_duplicates_count_values(spark):
    df = silver(spark, {}, {}, {}, {"trip_id": "b"}, {"trip_id": None}, {"trip_id": None})
    got = outcome(
        df, [Check("unique", ["trip_id", "tpep_pickup_datetime"]), Check("duplicates", "trip_id")]
    )
    assert got[("unique", "trip_id,tpep_pickup_datetime")] == (5, False)
    assert got[("duplicates", "trip_id")] == (1, False)


def test_missing_column_fails_its_checks_only(spark):
    df = silver(spark, {}).drop("vendor_id", "pickup_h3")
    bad = {key for key, (_, success) in outcome(df, silver_suite()).items() if not success}
    assert bad == {("exists", "vendor_id"), ("not_null", "pickup_h3"), ("regex", "pickup_h3")}
    got = outcome(df, [Check("unique", "vendor_id"), Check("type", "vendor_id", type="int")])
    assert not any(success for _, success in got.values())


def test_table_suite(spark):
    df = silver(spark, {"fare_amount": 5000.0}).withColumn("trip_id", F.lit(1))
    bad = {key for key, (_, success) in outcome(df, table_suite()).items() if not success}
    assert bad == {("maximum", "fare_amount"), ("type", "trip_id")}


def test_empty_table(spark):
    empty = silver(spark, {}).limit(0)
    bad = {key for key, (_, success) in outcome(empty, silver_suite()).items() if not success}
    assert bad == {("row_count", "")}
    bad = {key for key, (_, success) in outcome(empty, table_suite()).items() if not success}
    assert bad == {("row_count", ""), ("minimum", "fare_amount"), ("maximum", "fare_amount")}


def test_column_checks_are_one_pass(spark):
    plain = [check for check in silver_suite() if check.kind != "unique"]
    df = spark.range(10).selectExpr(
        "cast(id as string) as trip_id", "1 as vendor_id", "now() as tpep_pickup_datetime",
        f"'{CELL}' as pickup_h3", "1 as passenger_count", "1d as fare_amount",
        "1d as trip_duration_minutes",
    )
    plan = evaluate(df, plain)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_all_checks_are_one_pass(spark):
    df = spark.range(10).selectExpr("cast(id as string) as trip_id", "now() as tpep_pickup_datetime", "1d as fare_amount")
    checks = [
        Check("unique", ["trip_id", "tpep_pickup_datetime"]), Check("duplicates", "trip_id"),
        Check("minimum", "fare_amount", low=0), Check("row_count", above=0),
    ]
    plan = evaluate(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
    assert all(success for _, success in outcome(df, checks).values())
    other = [*checks, Check("unique", "fare_amount")]
    assert outcome(df, other)[("unique", "fare_amount")] == (10, False)


def test_orphans_of_several_dimensions_are_one_pass(spark):
    fact = spark.range(10).selectExpr("id % 3 as a", "id % 2 as b")
    dims = {"x": (spark.createDataFrame([(0,), (1,)], "k long"), {"a": "k"}), "y": (spark.createDataFrame([(0,), (1,)], "k long"), {"b": "k"})}
    got = orphans_of(fact, dims)
    assert got._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    assert sorted(map(tuple, got.collect())) == [(0, 0, "y"), (1, 3, "x")]


def test_verdict_and_gate(spark):
    report = evaluate(silver(spark, {"fare_amount": 2000.0}), silver_suite())
    assert tuple(verdict(report).first()) == (10, 1, False)
    with pytest.raises(QualityError, match=r"between\(fare_amount\)"):
        gate(report)


def test_unknown_check():
    with pytest.raises(ValueError):
        Check("median", "fare_amount")


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,)], "code int")
    dim = spark.createDataFrame([(1,), (2,), (None,)], "key int")
    assert tuple(orphans(fact, dim, {"code": "key"}).first()) == (2, 3)
    assert tuple(orphans(fact.limit(0), dim, {"code": "key"}).first()) == (0, 0)
