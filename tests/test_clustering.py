"""Files that a filter on any clustering column skips."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmart.sinks import compact, overwrite
from tripmart.sinks.clustering import curve_key
from tripmart.sources import read_table


def opened(path, column, low, high):
    """Files whose statistics do not rule out values between the two, and all files."""
    hit = total = 0
    for file in glob.glob(f"{path}/**/part-*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        groups = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        total += 1
        hit += any(s is None or not s.has_min_max or (s.min <= high and s.max >= low) for s in groups)
    return hit, total


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rng = random.Random(2)
    # a skewed number, a text, and a constant beside
    rows = [(int(2000 * rng.random() ** 3), f"{rng.randrange(5000):05}", 1, k) for k in range(8000)]
    rows += [(None, None, 1, -1), (5, None, 1, -2)]
    overwrite(spark.createDataFrame(rows, "a int, b string, c int, id long"), path, "1")
    return path


def test_a_filter_on_the_second_column_skips_files(spark, table):
    before = sorted(map(str, read_table(spark, table).collect()))
    size = int(read_table(spark, table)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    compact(spark, table, "2", ["a", "b"], target_bytes=size // 64)
    assert sorted(map(str, read_table(spark, table).collect())) == before
    version = f"{table}/v=2"
    hit, total = opened(version, "b", "02000", "02050")
    assert total >= 60 and hit <= total // 4
    hit, total = opened(version, "a", 100, 110)
    assert hit <= total // 4
    # in ranges of the first column nearly every file has every value of the second
    ranges = read_table(spark, table).repartitionByRange(64, "a", "b")
    overwrite(ranges, f"{table}-ranges", "1")
    hit, total = opened(f"{table}-ranges/v=1", "b", "02000", "02050")
    assert hit > total // 2


def test_curve_interleaves_ranks(spark):
    grid = spark.sql("select x, y from (select explode(sequence(0, 3)) x) lateral view explode(sequence(0, 3)) as y")
    found = grid.withColumn("key", curve_key(grid, ["x", "y"])).collect()
    order = [(r.x, r.y) for r in sorted(found, key=lambda r: r.key)]
    assert len({r.key for r in found}) == 16
    # the four quadrants one after the other, each in the same order
    assert [(x // 2, y // 2) for x, y in order] == [q for q in ((0, 0), (0, 1), (1, 0), (1, 1)) for _ in range(4)]


def test_curve_of_awkward_columns(spark):
    kinds = "n double, t timestamp, d date, s string, e string"
    rows = spark.createDataFrame([(float("nan"), None, None, "x", None), (1.5, None, None, "x", None)], kinds)
    rows = rows.union(spark.sql("select -1d, timestamp'2024-01-01', date'2024-01-01', '', null"))
    keyed = rows.withColumn("k", curve_key(rows, rows.columns))
    assert all(r.k is not None and r.k >= 0 for r in keyed.collect())
    nothing = rows.limit(0)
    assert nothing.withColumn("k", curve_key(nothing, ["n", "s"])).count() == 0
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_partitions_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).selectExpr("id", "id % 10 as a", "id % 7 as b", "cast(id % 3 as int) as p")
    overwrite(rows, path, "1", partition_by=["p"])
    compact(spark, path, "2", ["a", "b"])
    found = read_table(spark, path)
    assert found.count() == 1000 and found.select(F.countDistinct("p")).first()[0] == 3
