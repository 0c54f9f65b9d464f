"""Versioned tables, appends, compaction, sources and the incremental upsert."""

import glob
import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripmart.operators import upsert_incremental
from tripmart.schemas import TRIP_COLUMNS
from tripmart.session import scratch_path, shared_folder
from tripmart.sinks import tables
from tripmart.sinks import (
    MissingTable,
    PublishConflict,
    append_merge,
    compact,
    compact_origin,
    drop_old_versions,
    overwrite,
    publish,
    read_origins,
    resolve,
)
from tripmart.sources import (
    first_trips,
    normalize_trips,
    read_history,
    read_stream,
    read_table,
    read_zones,
    register,
    surrogate_trip_id,
)


def bag(df):
    return sorted(map(str, df.collect()))


def files(path):
    return glob.glob(f"{path}/**/part-*.parquet", recursive=True)


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path, "1")
    overwrite(read_table(spark, path).selectExpr("id * 10 as ten", "'x' as x"), path, "2")
    table = read_table(spark, path)
    assert table.columns == ["ten", "x"]
    assert [row["ten"] for row in table.orderBy("ten").collect()] == [0, 10, 20]


def test_unpublished_version_is_invisible(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path, "1")
    written = overwrite(spark.range(5), path, "2", publish_now=False)
    assert read_table(spark, path).count() == 3
    assert spark.read.parquet(written).count() == 5
    publish(spark, path, "2")
    assert read_table(spark, path).count() == 5
    assert resolve(spark, path).endswith("v=2")
    # The pointer is swapped in by renaming; nothing of the staging is left.
    assert [name for name in os.listdir(path) if "_current." in name and "crc" not in name] == []


def test_old_versions_are_dropped_but_never_the_current_or_an_unpublished_one(spark, tmp_path):
    path = str(tmp_path / "t")
    assert drop_old_versions(spark, path) == []
    for i in (3, 0, 2, 1):
        overwrite(spark.range(i + 1), path, str(i))
    overwrite(spark.range(9), path, "audited", publish_now=False)
    dropped = drop_old_versions(spark, path, keep=1)
    # in the order of publication, whatever the store says of times
    assert sorted(os.path.basename(name) for name in dropped) == ["v=0", "v=3"]
    assert sorted(n for n in os.listdir(path) if n.startswith("v=")) == ["v=1", "v=2", "v=audited"]
    assert read_table(spark, path).count() == 2
    assert drop_old_versions(spark, path, keep=1) == []


def test_versions_without_a_published_one_are_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path, "1", publish_now=False)
    assert read_table(spark, path, missing="none") is None
    with pytest.raises(MissingTable):
        read_table(spark, path)


def test_publish_only_over_what_was_read(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path, "1", over=None)
    overwrite(spark.range(10), path, "2", over="1")
    with pytest.raises(PublishConflict):
        overwrite(spark.range(3), path, "3", over="1")
    assert read_table(spark, path).count() == 10


def test_compaction_does_not_roll_back_a_publication(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path, "1")
    load = tables.load_published

    def meanwhile(*args):
        table = load(*args)
        overwrite(spark.range(10), path, "2")
        return table

    monkeypatch.setattr(tables, "load_published", meanwhile)
    with pytest.raises(PublishConflict):
        compact(spark, path, "3", ["id"])
    monkeypatch.undo()
    assert read_table(spark, path).count() == 10


def test_replaced_partitions_leave_the_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, day string")
    overwrite(df, path, "1", partition_by=["day"])
    new = spark.createDataFrame([(2, "b"), (5, "b"), (6, "d")], "id int, day string")
    tables.replace_partitions(new, path, "2", "day", ["b", "d", "c", None])
    table = read_table(spark, path)
    assert table.columns == ["id", "day"]
    assert bag(table) == bag(spark.createDataFrame([(1, "a"), (2, "b"), (5, "b"), (6, "d")], df.schema))
    assert {f.split("/")[-2] for f in files(f"{path}/v=2")} == {"day=b", "day=d"}
    plan = table.filter("day = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    # the first version still holds a partition
    assert drop_old_versions(spark, path, keep=0) == []
    compact(spark, path, "3", ["id"])
    assert bag(read_table(spark, path).select("id", "day")) == bag(table)
    assert {f.split("/")[-2] for f in files(f"{path}/v=3")} == {"day=a", "day=b", "day=d"}


def test_compaction_of_an_origin(spark, tmp_path):
    path = str(tmp_path / "b")
    for batch in range(4):
        append_merge(spark.range(batch * 10, batch * 10 + 5), path, "live", str(batch))
    append_merge(spark.range(100, 103), path, "seed", "0")
    before = bag(read_origins(spark, path, ["seed", "live"]))
    with pytest.raises(ValueError):
        compact(spark, path, "1", ["id"])
    compact_origin(spark, path, "live", "1")
    assert sorted(n for n in os.listdir(f"{path}/origin=live") if n.startswith("batch")) == ["batch=compacted-1"]
    assert bag(read_origins(spark, path, ["seed", "live"])) == before
    # a repeated batch is known to be in, a new one is added
    append_merge(spark.range(0, 5), path, "live", "0")
    append_merge(spark.range(200, 201), path, "live", "4")
    assert read_origins(spark, path, ["seed", "live"]).count() == len(before) + 1
    compact_origin(spark, path, "live", "2")
    append_merge(spark.range(0, 5), path, "live", "0")
    assert read_origins(spark, path, ["seed", "live"]).count() == len(before) + 1
    assert compact_origin(spark, path, "absent", "3") is None


def test_unfinished_batch_is_not_read(spark, tmp_path):
    path = str(tmp_path / "b")
    target = append_merge(spark.range(3), path, "seed", "0")
    os.remove(f"{target}/_SUCCESS")
    assert read_origins(spark, path, ["seed"]) is None
    append_merge(spark.range(5), path, "seed", "0")
    assert read_origins(spark, path, ["seed"]).count() == 5


def test_time_columns_carry_statistics(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    overwrite(fact(spark, ("a", 1, 1)).coalesce(1), path, "1")
    column = pq.ParquetFile(files(path)[0]).metadata.row_group(0).column(2)
    assert column.path_in_schema == "_ingest_ts" and column.physical_type == "INT64"
    assert column.statistics.has_min_max


def test_partitioned_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "cast(if(id % 3 = 0, 0, id % 5) as int) as day")
    overwrite(df, path, "1", partition_by=["day"])
    table = read_table(spark, path)
    assert bag(table.select("id", "day")) == bag(df)
    plan = table.filter("day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_missing_table(spark, tmp_path):
    path = str(tmp_path / "nothing")
    assert read_table(spark, path, missing="none") is None
    with pytest.raises(AnalysisException):
        read_table(spark, path)
    with pytest.raises(ValueError):
        read_table(spark, path, missing="ignore")


def test_only_a_missing_table_is_forgiven(spark, tmp_path):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_table(spark, str(path), missing="none")


def test_append_merges_schemas_and_repeats_nothing(spark, tmp_path):
    path = str(tmp_path / "b")
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    new = spark.createDataFrame([(2, 0.5)], "id int, score double")
    append_merge(old, path, "seed", "0")
    append_merge(old, path, "seed", "0")
    append_merge(new, path, "seed", "1")
    append_merge(new.withColumn("extra", F.lit("e")), path, "live", "0")
    table = read_origins(spark, path, ["seed", "live", "absent"])
    assert set(table.columns) == {"id", "name", "score", "extra"}
    assert table.count() == 3
    declared = read_origins(spark, path, ["seed", "live"], old.schema)
    assert bag(declared) == bag(
        spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, name string")
    )
    assert read_origins(spark, str(tmp_path / "none"), ["seed"]) is None


def test_compact_keeps_rows_and_clusters(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).selectExpr(
        # One value holds half of the rows.
        "cast(if(id % 2 = 0, 7, id % 100) as int) as zone",
        "sha2(cast(id as string), 256) as text",
    )
    overwrite(df.repartition(40), path, "1")
    before = read_table(spark, path)
    size = sum(os.path.getsize(f) for f in files(path))
    compact(spark, path, "2", ["zone"], target_bytes=size // 8)
    after = read_table(spark, path)
    assert bag(after) == bag(before)
    written = files(f"{path}/v=2")
    assert 6 <= len(written) <= 10
    rows = [spark.read.parquet(f).count() for f in written]
    assert max(rows) < 3 * (20_000 / len(written))
    spans = [
        spark.read.parquet(f).agg(F.max("zone") - F.min("zone")).first()[0] for f in written
    ]
    assert sum(span == 0 for span in spans) >= 3


def fact(spark, *rows):
    parsed = [(k, v, datetime(2024, 1, day)) for k, v, day in rows]
    return spark.createDataFrame(parsed, "trip_id string, v int, _ingest_ts timestamp")


# The increment below has three keys and shares two of them with the target, so the limits
# make it broadcast its keys, broadcast the shared keys, and shuffle.
@pytest.mark.parametrize("max_rows, joins", [(3, True), (2, True), (1, False)])
def test_upsert(spark, max_rows, joins):
    target = fact(spark, ("a", 1, 1), ("b", 1, 2), (None, 1, 1))
    source = fact(
        spark,
        ("a", 2, 3),
        ("a", 3, 4),
        ("b", 9, 2),  # equal to the mark: not seen
        ("c", 1, 5),
        ("d", 1, 1),  # below the mark: not seen
        (None, 2, 6),
    )
    merged = upsert_incremental(target, source, "trip_id", "_ingest_ts", max_rows=max_rows)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == joins
    got = {(row["trip_id"], row["v"]) for row in merged.collect()}
    assert got == {("a", 3), ("b", 1), ("c", 1), (None, 2)}
    assert merged.count() == 4


def test_upsert_into_empty_target(spark):
    source = fact(spark, ("a", 1, 1), ("a", 2, 2))
    merged = upsert_incremental(source.limit(0), source, "trip_id", "_ingest_ts")
    assert [(row["trip_id"], row["v"]) for row in merged.collect()] == [("a", 2)]


def test_upsert_in_two_steps_equals_one(spark, tmp_path):
    source = fact(spark, *[(f"k{i % 7}", i, 1 + i % 20) for i in range(100)])
    empty = source.limit(0)
    key = ("trip_id", "_ingest_ts", ["v"])
    once = upsert_incremental(empty, source, *key)
    path = str(tmp_path / "fact")
    early = source.filter(F.col("_ingest_ts") <= datetime(2024, 1, 9))
    overwrite(upsert_incremental(empty, early, *key), path, "1")
    overwrite(upsert_incremental(read_table(spark, path), source, *key), path, "2")
    assert bag(read_table(spark, path)) == bag(once)
    overwrite(upsert_incremental(read_table(spark, path), source, *key), path, "3")
    assert bag(read_table(spark, path)) == bag(once)


def test_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "s")
    overwrite(fact(spark, ("a", 1, 1)).coalesce(1), path, "1")
    table = read_table(spark, path)
    plan = upsert_incremental(table, table, "trip_id", "_ingest_ts")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(_ingest_ts,ScalarSubquery" in text


def test_zone_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Zone,Borough,lat,lon\n1,North,A,40.7,-74.0\nx,Bad,B,n/a,\n")
    rows = read_zones(spark, str(path)).collect()
    assert [tuple(row) for row in rows] == [
        (1, "North", "A", 40.7, -74.0),
        (None, "Bad", "B", None, None),
    ]


RAW = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, "
    "store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type bigint, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, "
    "tolls_amount double, improvement_surcharge double, total_amount double, "
    "congestion_surcharge double, Airport_fee double"
)
NOON = datetime(2024, 1, 1, 12)


def raw_file(spark):
    full = (2, NOON, NOON, 1.0, 2.5, 1.0, "N", 7, 8, 1) + (1.0,) * 7 + (2.5, 1.25)
    gaps = (None, None, NOON) + (None,) * 16
    return spark.createDataFrame([full, gaps, full], RAW)


def test_history_is_kept_as_it_is(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_file(spark).withColumn("colour", F.lit("c")).write.parquet(path)
    history = read_history(spark, path)
    assert set(history.columns) == {*TRIP_COLUMNS, "colour"}
    rows = history.collect()
    full = next(row for row in rows if row["vendor_id"] == 2)
    gaps = next(row for row in rows if row["vendor_id"] is None)
    assert full["tpep_pickup_datetime"] == NOON and full["passenger_count"] == 1.0
    assert gaps["fare_amount"] is None and gaps["PULocationID"] is None
    # The same row always has the same id, so a replay can be recognised.
    assert len({row["trip_id"] for row in rows}) == 2
    assert read_history(spark, None) is None


def test_ids_tell_every_column_apart(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = raw_file(spark).limit(1)
    others = [raw.withColumn(c, F.lit(9).cast(raw.schema[c].dataType)) for c in ("tip_amount", "extra")]
    raw.union(others[0]).union(others[1]).write.parquet(path)
    ids = {row["trip_id"] for row in read_history(spark, path).collect()}
    assert len(ids) == 3 and all(len(i) == len("trip_") + 64 for i in ids)


def test_existing_ids_are_kept(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_file(spark).withColumn("trip_id", F.lit(17)).write.parquet(path)
    assert {row["trip_id"] for row in read_history(spark, path).collect()} == {"17"}


def test_surrogate_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    ids = surrogate_trip_id(df, ["x", "y", "z"])
    assert ids.select("trip_id").distinct().count() == 2


def test_first_rows_need_an_order(spark):
    df = raw_file(spark)
    with pytest.raises(ValueError):
        first_trips(df, 1, None)
    first = normalize_trips(df, limit=1, order_by=["tpep_pickup_datetime"])
    assert [row["vendor_id"] for row in first.collect()] == [0]


def test_named_source(spark):
    register(spark.range(4), "silver_trips_named")
    assert spark.sql("select count(*) from silver_trips_named").first()[0] == 4


def test_stream_from_one_file_or_a_folder(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(10).coalesce(1).write.parquet(path)
    for source in (path, files(path)[0]):
        out = scratch_path(spark, "one-file")
        stream = read_stream(spark, "parquet", spark.range(1).schema, source)
        query = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{out}/rows")
        )
        query.awaitTermination()
        assert spark.read.parquet(f"{out}/rows").count() == 10


class FakeSession:
    """Just the two settings that decide where shared files go."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master)


def test_shared_folder_is_the_one_the_cluster_names():
    named = FakeSession("spark://host:7077", "/shared/checkpoints/")
    assert shared_folder(named) == "/shared/checkpoints"
    assert scratch_path(named, "x").startswith("/shared/checkpoints/")
    assert scratch_path(named, "x") != scratch_path(named, "x")
    assert shared_folder(FakeSession("local[8]"))
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession("spark://host:7077"))
