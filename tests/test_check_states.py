"""Reports out of the states of partitions, against the report over the whole table."""

import pytest
from pyspark.sql import functions as F
from test_clean import bronze
from test_incremental import arrive, spoil, stamped, trip
from test_medallion import good_zones

from tripmart.operators import QualityError
from tripmart.operators.check_states import refresh_checks
from tripmart.operators.checks import Check, evaluate
from tripmart.plans import LakeConfig, run_pipeline
from tripmart.sinks import overwrite
from tripmart.sinks import tables as sinks
from tripmart.sources import read_table

SUITE = [
    Check("row_count", above=3),
    Check("exists", "id"),
    Check("exists", "nothing"),
    Check("not_null", "fare"),
    Check("between", "fare", low=0, high=10),
    Check("regex", "note", pattern="^x"),
    Check("minimum", "fare", low=0),
    Check("maximum", "fare", below=9),
    Check("type", "fare", type="double"),
    Check("type", "fare", type="int"),
    Check("unique", ["id", "day"]),
    Check("unique", "id"),
    Check("duplicates", "id"),
    Check("duplicates", ["id", "note"]),
    Check("unique", "nothing"),
]
ROWS = "id string, day string, fare double, note string"


def report(df):
    return sorted(map(str, df.collect()))


def table(spark, *rows):
    return spark.createDataFrame(rows, ROWS).withColumn("p", F.col("day"))


def check(spark, root, run, touched=None, follows=None):
    """States in ``root`` brought up to the published table; returns the report."""
    done = refresh_checks(
        spark, SUITE, f"{root}/t", f"{root}/states", run, None, sinks.current_parts(spark, f"{root}/t"), touched, follows,
        partition="p", determines=["day"], buckets=64,
    )
    done.publish()
    return report(done.report)


def test_report_follows_touched_partitions(spark, tmp_path):
    root = str(tmp_path)
    path = f"{root}/t"
    first = table(
        spark, ("a", "1", 1.0, "x"), ("b", "1", 2.0, "x"), ("b", "1", 3.0, None), ("c", "2", 4.0, "y"), ("a", "3", 5.0, "x"),
        (None, "3", None, None), (None, "2", 1.0, "x"), ("d", None, -1.0, "x"),
    )
    overwrite(first, path, "1", partition_by=["p"])
    assert check(spark, root, "1") == report(evaluate(read_table(spark, path), SUITE))

    # "a" of the 3rd becomes unique, "c" gets a second row, a new partition, one goes
    new = table(spark, ("c", "3", 9.5, "x"), ("e", "3", 0.5, None), ("f", "4", 3.0, "x"), ("e", "4", 3.0, None))
    sinks.replace_partitions(new, path, "2", "p", ["3", "4", None])
    expected = report(evaluate(read_table(spark, path), SUITE))
    counts = f"{root}/states/keys0/counts"
    before = sinks.current_parts(spark, counts)
    spoil(f"{path}/v=1/p=1")
    assert check(spark, root, "2", ["3", "4", None], "1") == expected
    after = sinks.current_parts(spark, counts)
    assert set(after.values()) == {"1", "2"} and set(before.values()) == {"1"}

    # nothing touched: the same report, and no bucket is written
    sinks.publish(spark, path, "2", "2", sinks.current_parts(spark, path))
    assert check(spark, root, "3", [], "2") == expected
    assert sinks.current_parts(spark, counts) == after
    # states of another version: everything is read, also what cannot be read
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        check(spark, root, "4", ["3"], "unknown")


def test_states_not_published_are_not_built_on(spark, tmp_path):
    root = str(tmp_path)
    path = f"{root}/t"
    overwrite(table(spark, ("a", "1", 1.0, "x"), ("b", "2", 1.0, "x")), path, "1", partition_by=["p"])
    check(spark, root, "1")
    sinks.replace_partitions(table(spark, ("a", "2", 50.0, "x")), path, "2", "p", ["2"])
    args = (spark, SUITE, path, f"{root}/states", "rejected", None, sinks.current_parts(spark, path), ["2"], "1", "p", ["day"])
    refused = refresh_checks(*args, buckets=64)
    assert any(not r.success for r in refused.report.collect())
    # the rejected run leaves the states where they were, so the next one starts from them
    assert check(spark, root, "2", ["2"], "1") == report(evaluate(read_table(spark, path), SUITE))


def test_another_suite_starts_over(spark, tmp_path):
    root = str(tmp_path)
    overwrite(table(spark, ("a", "1", 1.0, "x")), f"{root}/t", "1", partition_by=["p"])
    check(spark, root, "1")
    done = refresh_checks(
        spark, SUITE[:3], f"{root}/t", f"{root}/states", "2", touched=[], follows="1", partition="p", determines=["day"]
    )
    assert report(done.report) == report(evaluate(read_table(spark, f"{root}/t"), SUITE[:3]))


def test_gate_of_incremental_runs(spark, tmp_path):
    cfg = LakeConfig(root=str(tmp_path), zones=good_zones(spark), incremental=True)
    arrive(spark, cfg.bronze_path, "seed", "0", stamped(trip("a", 1), 5), stamped(trip("b", 2), 5))
    run_pipeline(spark, cfg, "1")
    # a fare beyond the limit is refused, and refused again
    arrive(spark, cfg.bronze_path, "live", "0", stamped(trip("b", 2, fare_amount=2000.0), 6))
    for run in ("2", "3"):
        with pytest.raises(QualityError, match="fare_amount"):
            run_pipeline(spark, cfg, run)
        assert sinks.published(spark, cfg.silver_path) == "1"
    # corrected, it passes: what was refused is taken up with the rest
    arrive(spark, cfg.bronze_path, "live", "1", stamped(trip("b", 2, fare_amount=20.0), 7))
    spoil(f"{cfg.silver_path}/v=1/pickup_date=2024-01-01")
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        run_pipeline(spark, cfg, "4")  # gold's dimensions read all of silver
    assert sinks.published(spark, cfg.silver_path) == "4"
