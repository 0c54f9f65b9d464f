"""Rows that are deduplicated and laid out by partition in one shuffle, or not moved at all."""

import glob
import re

import pytest
from tripmart.operators import dedupe
from tripmart.sinks.tables import compact, overwrite, replace_partitions
from tripmart.workload import adapter, queries

SCHEMA = "k string, part int, at int, w int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def repeated(spark):
    rows = [(f"k{i % 40}", None if i % 40 == 7 else i % 3, i, i) for i in range(0, 360, 3)]
    rows = [(k, None if p is None else int(k[1:]) % 3, at, v) for k, p, at, v in rows]
    rows += [(None, 5, 1, 1), (None, 5, 2, 2), ("k1", 1, None, 9), ("equal", 0, 4, 1), ("equal", 0, 4, 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("rows_per_part", [4, 30, 10**6])
def test_latest_by_partition_is_latest_per_key(spark, repeated, rows_per_part):
    found = dedupe.latest_by_partition(repeated, ["k", "part"], "at", ["w"], "part", rows_per_part)
    assert rows_of(found) == rows_of(dedupe.latest_per_key(repeated, ["k", "part"], "at", ["w"]))
    assert found.columns == repeated.columns


def test_latest_by_partition_shuffles_rows_once(spark, repeated):
    found = dedupe.latest_by_partition(repeated, ["k", "part"], "at", ["w"], "part", 10**6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\((\w+)", plan) == ["part"], plan


def test_hot_key_is_cut_down_inside_the_input_tasks(spark):
    df = spark.createDataFrame([("hot", 1, i, 0) for i in range(3000)], SCHEMA)
    found = dedupe.latest_by_partition(df, ["k"], "at", ["w"], "part", 1000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(k") < plan.index("Partial")
    assert [r.at for r in found.collect()] == [2999]


def test_latest_of_repeated(spark, repeated):
    expected = rows_of(dedupe.latest_per_key(repeated, ["k"], "at", ["w"]))
    assert rows_of(dedupe.latest_of_repeated(repeated, ["k"], "at", ["w"])) == expected
    assert dedupe.latest_of_repeated(repeated, ["k"], "at", ["w"], max_rows=3) is None
    once = repeated.filter("at < 30 or k is null")
    found = dedupe.latest_of_repeated(once, ["k"], "at", ["w"])
    assert rows_of(found) == rows_of(dedupe.latest_per_key(once, ["k"], "at", ["w"]))


def test_balanced_rows_are_written_as_they_lie(spark, repeated, tmp_path):
    path = str(tmp_path / "t")
    overwrite(repeated, path, "1", partition_by=["part"], balanced=True)
    assert rows_of(spark.read.parquet(f"{path}/v=1").select(*repeated.columns)) == rows_of(repeated)
    replace_partitions(repeated.filter("part = 1"), path, "2", "part", [1], balanced=True)
    assert spark.read.parquet(f"{path}/v=2").count() == repeated.filter("part = 1").count()


def test_trips_meet_customers_by_their_orders(spark):
    """The lines are not shuffled by customer, and the rows are those of the SQL."""
    sf_dir = "/root/testdata/sf0.001"
    tables = {n: adapter.table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "supplier")}
    found, expected = adapter.trips(spark, sf_dir), spark.sql(adapter.TRIPS_SQL, **tables)
    assert found.schema == expected.schema
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    lines = [x for x in plan.splitlines() if "Join Inner" in x]
    assert "c_custkey" in lines[2] and "l_orderkey" in lines[1], plan


def test_streams_are_dealt_only_where_files_make_few_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(8).repartition(2), spark.range(800).repartition(cores)
    assert adapter.dealt(few, many) is few
    assert adapter.dealt(few, few).rdd.getNumPartitions() == cores


def test_cells_are_worked_out_by_all_cores(spark):
    """One small customer file is one split."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = queries()["globe_cells"](spark, "/root/testdata/sf0.001")
    assert cells.rdd.getNumPartitions() == 2 * tasks


def test_no_task_of_a_compaction_sorts_more_rows_than_it_may(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4000).selectExpr("id", "id % 7 as g")
    overwrite(df, path, "1")
    compact(spark, path, "2", ["id", "g"], sorted_rows=500)
    files = glob.glob(f"{path}/v=2/part-*.parquet")
    assert len(files) == 8 and max(spark.read.parquet(f).count() for f in files) < 800
    assert rows_of(spark.read.parquet(f"{path}/v=2")) == rows_of(df)
