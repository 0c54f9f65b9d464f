"""Messages of several writers, broken messages, and the newest row per key of a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_clean import TRIP
from test_streaming import messages, topic, trips

from tripmart.functions import frame_rows
from tripmart.functions.registry import ANY_ID, decode_by_id, read_schemas, write_schemas
from tripmart.operators import latest_per_key
from tripmart.plans.bronze import read_bronze
from tripmart.schemas import TRIP_COLUMNS, TRIP_SCHEMA
from tripmart.session import prepare_session
from tripmart.sinks import read_origins
from tripmart.sources import read_stream
from tripmart.streaming import keep_newest, land_checked, read_newest, run_bronze_stream
from tripmart.streaming import landing, newest

READER = T.StructType(
    [
        T.StructField("trip_id", T.StringType(), False),
        T.StructField("n", T.LongType(), True),
        T.StructField("fare", T.DoubleType(), False),
        T.StructField("note", T.StringType(), True),
    ]
)
TYPES = {"s": T.StringType(), "i": T.IntegerType(), "d": T.DoubleType()}


def schema(**fields):
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields.items()])


WRITERS = {
    1: schema(trip_id="s", n="i", fare="d"),
    2: schema(id="s", n="s", note="i"),
    300: schema(trip_id="s", fare="i", extra="s", note="s"),
}


def framed(spark, *rows):
    """(schema id or None for no header, body)."""
    data = []
    for i, (k, body) in enumerate(rows):
        head = b"" if k is None else b"\x00" + k.to_bytes(4, "big")
        data.append((i, None if body is None else bytearray(head + body.encode())))
    return spark.createDataFrame(data, "offset long, value binary")


def decode(spark, *rows, writers=WRITERS):
    found = decode_by_id(framed(spark, *rows), writers, READER, {"trip_id": ["id"]}, {"fare": 0.0})
    return found.orderBy("trip_id").collect(), found


def test_records_are_resolved_from_their_writers(spark):
    rows, found = decode(
        spark,
        (1, '{"trip_id":"a","n":5,"fare":1.5}'),
        (2, '{"id":"b","n":"6","note":7}'),
        (300, '{"trip_id":"c","fare":2,"extra":"x","note":"y","more":1}'),
        (2, '{"id":"d","n":"many"}'),
    )
    assert found.columns == ["trip_id", "n", "fare", "note", "frame_schema_id", "_problem", "_raw"]
    assert [tuple(r)[:5] for r in rows] == [
        ("a", 5, 1.5, None, 1), ("b", 6, 0.0, "7", 2), ("c", None, 2.0, "y", 300), ("d", None, 0.0, None, 2),
    ]
    assert all(r._problem is None and r._raw is None for r in rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Sort")[-1] and "Python" not in plan


def test_broken_messages_say_why(spark):
    broken = [
        (9, '{"trip_id":"a"}'), (1, '{"trip_id":"a"'), (1, '{"trip_id":"a","n":"x"}'), (1, "{}"), (1, ""),
        (None, "\x01abcde"), (None, "\x00\x00"), (None, None), (1, '{"trip_id":null,"fare":1}'),
    ]
    _, found = decode(spark, *broken)
    rows = sorted(found.collect(), key=lambda r: r._raw.offset)
    assert [r._problem for r in rows] == [
        "unknown schema id", "malformed record", "malformed record", "no value for trip_id", "malformed record",
        "no frame", "no frame", "no frame", "no value for trip_id",
    ]
    assert [r.frame_schema_id for r in rows] == [9, 1, 1, 1, 1, None, None, None, 1]
    assert bytes(rows[0]._raw.value) == b'\x00\x00\x00\x00\x09{"trip_id":"a"}' and rows[7]._raw.value is None


def test_any_id_and_no_ids(spark):
    rows, _ = decode(spark, (77, '{"trip_id":"a"}'), (1, '{"trip_id":"b","n":1}'), writers={1: WRITERS[1], ANY_ID: WRITERS[300]})
    assert [(r.trip_id, r.n, r._problem) for r in rows] == [("a", None, None), ("b", 1, None)]
    rows, _ = decode(spark, (77, '{"trip_id":"a"}'), writers={ANY_ID: WRITERS[300]})
    assert rows[0].trip_id == "a"
    rows, _ = decode(spark, (77, '{"trip_id":"a"}'), (None, "x"), writers={})
    assert sorted(r._problem for r in rows) == ["no frame", "unknown schema id"]


def test_table_of_schemas(spark, tmp_path):
    path = str(tmp_path / "schemas")
    write_schemas(spark, {1: WRITERS[1], 2: WRITERS[2]}, path)
    write_schemas(spark, {300: WRITERS[300], 1: WRITERS[1]}, path)
    assert read_schemas(spark, path) == WRITERS
    write_schemas(spark, {1: WRITERS[2]}, path)
    with pytest.raises(ValueError, match="two schemas"):
        read_schemas(spark, path)


def broken_topic(spark, source, *ids):
    good = messages(spark, *ids)
    bad = good.withColumn("value", F.concat(F.col("value"), F.lit("}").cast("binary")).substr(1, 40)).limit(1)
    good.unionByName(bad).coalesce(1).write.mode("append").parquet(source)


def test_each_message_is_on_one_side_once(spark, tmp_path, monkeypatch):
    source, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "ck"))
    broken_topic(spark, source, "a", "b")

    def run():
        run_bronze_stream(topic(spark, source), bronze, checkpoint, mode="QUARANTINE").awaitTermination()

    # the job dies after the good rows, before the broken ones
    append = landing.append_merge

    def dies(df, path, origin, *rest):
        if origin == "quarantine":
            raise OSError("gone")
        return append(df, path, origin, *rest)

    monkeypatch.setattr(landing, "append_merge", dies)
    with pytest.raises(Exception, match="gone"):
        run()
    assert read_origins(spark, bronze, ["quarantine"]) is None
    monkeypatch.setattr(landing, "append_merge", append)
    run()
    broken_topic(spark, source, "c")
    run()
    run()
    assert sorted(r.trip_id for r in read_bronze(spark, bronze).collect()) == ["a", "b", "c"]
    kept = read_origins(spark, bronze, ["quarantine"]).collect()
    assert [(r.reason, r.frame_schema_id, len(r.value)) for r in kept] == [("malformed record", 5, 40)] * 2
    assert all(r.key is not None and r.timestamp == datetime(2024, 1, 1) for r in kept)
    # bronze is read without the quarantine
    assert read_bronze(spark, bronze).count() == 3


def test_nothing_broken_leaves_no_quarantine(spark, tmp_path):
    source, bronze = str(tmp_path / "in"), str(tmp_path / "bronze")
    messages(spark, "a").write.parquet(source)
    known = {5: TRIP_SCHEMA}
    run_bronze_stream(topic(spark, source), bronze, str(tmp_path / "ck"), writers=known).awaitTermination()
    assert read_origins(spark, bronze, ["quarantine"]) is None
    assert read_bronze(spark, bronze).select(*TRIP_COLUMNS).first().asDict() == {k: TRIP[k] for k in TRIP_COLUMNS}


EVENTS = "key string, at timestamp, id long, v string"
BY = (["key"], "at", ["id"])


@pytest.mark.parametrize("fold_every", [2, 100])
def test_newest_row_per_key_in_any_order(spark, tmp_path, fold_every):
    rng = random.Random(8)
    start = datetime(2024, 1, 1)
    rows = [
        (rng.choice("abcdefg"), start + timedelta(hours=rng.randrange(200)), i, f"v{i}") for i in range(120)
    ]
    rows += [("hot", start + timedelta(hours=k % 7), 1000 + k, "x") for k in range(60)]
    rows += [("null", None, 2000, "only"), (None, start, 2001, "no key"), ("a", None, 2002, "loses")]
    rng.shuffle(rows)
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    for part in range(5):
        spark.createDataFrame(rows[part::5], EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream = read_stream(spark, "parquet", spark.read.parquet(source).schema, source)
        keep_newest(stream, path, f"{path}/ck", *BY, delay="12 hours", fold_every=fold_every).awaitTermination()
    found = read_newest(spark, path, *BY)
    expected = latest_per_key(spark.createDataFrame(rows, EVENTS), *BY)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))

    # what is late is what came 12 hours after the greatest time of earlier batches
    seen, late = None, set()
    for part in range(5):
        own = [r for r in rows[part::5]]
        late |= {r[2] for r in own if r[1] and seen and r[1] < seen - timedelta(hours=12)}
        seen = max([seen or start, *(r[1] for r in own if r[1])])
    assert {r.id for r in read_origins(spark, path, [newest.LATE]).collect()} == late and late
    in_time = latest_per_key(spark.createDataFrame([r for r in rows if r[2] not in late], EVENTS), *BY)
    assert sorted(map(str, read_newest(spark, path, *BY, late=False).collect())) == sorted(map(str, in_time.collect()))
    kept = len(newest.batches(spark, path, newest.NEWEST))
    assert kept < fold_every if fold_every == 2 else kept == 5


def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    day = datetime(2024, 1, 1)

    def run():
        stream = read_stream(spark, "parquet", spark.read.parquet(source).schema, source)
        keep_newest(stream, path, f"{path}/ck", *BY, delay="1 hour", fold_every=3).awaitTermination()

    def add(*rows):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)

    add(("a", day, 1, "x"))
    run()
    # the second batch dies after its rows and its mark are written
    add(("a", day + timedelta(days=2), 2, "y"), ("b", day, 3, "z"))
    read = newest.batches
    monkeypatch.setattr(newest, "batches", lambda *a: 1 / 0)
    with pytest.raises(Exception, match="ZeroDivision|division by zero"):
        run()
    monkeypatch.setattr(newest, "batches", read)
    # repeated, "b" is judged by the mark of the first batch and is in time
    run()
    assert read_origins(spark, path, [newest.LATE]) is None
    add(("b", day, 4, "late"), ("c", day + timedelta(days=2), 5, "w"))
    run()
    assert [r.id for r in read_origins(spark, path, [newest.LATE]).collect()] == [4]
    assert sorted((r.key, r.id) for r in read_newest(spark, path, *BY).collect()) == [("a", 2), ("b", 4), ("c", 5)]
    assert sorted((r.key, r.id) for r in read_newest(spark, path, *BY, late=False).collect()) == [("a", 2), ("b", 3), ("c", 5)]


def test_decoding_of_wide_records_is_not_interpreted(spark):
    # HotSpot compiles no method of more than 8,000 bytes
    limit = "spark.sql.codegen.hugeMethodLimit"
    assert int(spark.conf.get(limit)) <= 8000
    other = spark.newSession()
    other.conf.set(limit, "65535")
    prepare_session(other)
    assert int(other.conf.get(limit)) <= 8000


def test_rows_of_several_writers_are_framed_in_one_pass(spark):
    rows = spark.createDataFrame([("a", 1, 2.5), ("b", 2, None), ("c", 3, 1.0), ("d", None, 1.0)], "id string, n int, x double")
    writers = {
        7: (F.col("n") == 1, F.struct("id", F.col("x").cast("string").alias("x"))),
        300: (F.col("n") <= 2, F.struct(F.col("id").alias("ID"), "x")),
    }
    framed = frame_rows(rows, "id", writers=writers)
    got = {bytes(r.key): bytes(r.value) for r in framed.collect()}
    assert got == {
        b"a": b'\x00\x00\x00\x00\x07{"id":"a","x":"2.5"}',
        b"b": b'\x00\x00\x00\x01\x2c{"ID":"b","x":null}',
    }
    assert "Union" not in framed._jdf.queryExecution().optimizedPlan().toString()
