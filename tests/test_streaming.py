"""Frames, landing, restart and event dedupe."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_clean import TRIP

from tripmart.functions import decode_frames, frame_rows
from tripmart.functions.frames import avro_schema
from tripmart.plans.bronze import read_bronze, run_bronze
from tripmart.schemas import BRONZE_COLUMNS, TRIP_COLUMNS, TRIP_SCHEMA
from tripmart.sinks import append_merge
from tripmart.sources import read_stream
from tripmart.streaming import run_bronze_stream, stream_dedupe

MESSAGES = "key binary, value binary, timestamp timestamp"


def trips(spark, *ids):
    rows = [tuple({**TRIP, "trip_id": i}[name] for name in TRIP_COLUMNS) for i in ids]
    return spark.createDataFrame(rows, TRIP_SCHEMA)


def messages(spark, *ids):
    return frame_rows(trips(spark, *ids), "trip_id", 5).withColumn(
        "timestamp", F.lit(datetime(2024, 1, 1))
    )


def topic(spark, path):
    return read_stream(spark, "parquet", spark.createDataFrame([], MESSAGES).schema, path)


def test_frame_header_and_round_trip(spark):
    framed = messages(spark, "a", "b")
    assert framed.select("key", "value", "timestamp").first()["key"] == bytearray(b"a")
    assert bytes(framed.first()["value"][:5]) == b"\x00\x00\x00\x00\x05"
    decoded = decode_frames(framed, header=True)
    assert decoded.columns == [*TRIP_COLUMNS, "kafka_ts", "frame_magic", "frame_schema_id"]
    assert sorted(map(str, decoded.select(*TRIP_COLUMNS).collect())) == sorted(
        map(str, trips(spark, "a", "b").collect())
    )
    assert decoded.first()["frame_schema_id"] == 5


def test_long_body_is_not_cut(spark):
    long_id = "x" * 1_200_000
    decoded = decode_frames(frame_rows(trips(spark, long_id), "trip_id"))
    assert decoded.first()["trip_id"] == long_id


def test_broken_record(spark):
    broken = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01{nope"),)], "value binary")
    with pytest.raises(Exception, match="(?i)malformed"):
        decode_frames(broken).collect()
    assert decode_frames(broken, mode="PERMISSIVE").first()["trip_id"] is None


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        frame_rows(trips(spark, "a"), "trip_id", codec="xml")


def test_avro_schema_text():
    text = avro_schema()
    assert '{"name": "trip_id", "type": "string"}' in text
    assert '{"name": "passenger_count", "type": ["null", "int"], "default": null}' in text


def test_seed_beside_stream_and_restart(spark, tmp_path):
    source, bronze, checkpoint, raw = (str(tmp_path / n) for n in ("in", "bronze", "ck", "raw"))
    trips(spark, "h1", "h2").write.parquet(raw)
    messages(spark, "a", "b").write.parquet(source)

    def run():
        return run_bronze(spark, bronze, raw, topic(spark, source), checkpoint)

    first = run()
    assert first.columns == BRONZE_COLUMNS
    sources = {row["trip_id"]: row["record_source"] for row in first.collect()}
    assert sources == {
        "h1": "historical_parquet",
        "h2": "historical_parquet",
        "a": "kafka_live",
        "b": "kafka_live",
    }
    stamps = {row["trip_id"]: row["kafka_ts"] for row in first.collect()}
    assert stamps["a"] == datetime(2024, 1, 1) and stamps["h1"] is None
    assert all(row["_ingest_ts"] is not None for row in first.collect())

    # A second start adds nothing; new messages are added once.
    assert run().count() == 4
    messages(spark, "c", "a").write.mode("append").parquet(source)
    assert run().count() == 6
    assert run().count() == 6


def test_batch_rows_beside_the_stream_are_seen(spark, tmp_path):
    source, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "ck"))
    messages(spark, "a").write.parquet(source)
    run_bronze_stream(topic(spark, source), bronze, checkpoint).awaitTermination()
    append_merge(trips(spark, "h"), bronze, "seed", "0")
    assert {row["trip_id"] for row in read_bronze(spark, bronze).collect()} == {"a", "h"}


def test_nothing_to_run(spark, tmp_path):
    assert run_bronze(spark, str(tmp_path / "bronze")) is None
    with pytest.raises(ValueError):
        run_bronze(spark, str(tmp_path / "bronze"), stream=spark.readStream.format("rate").load())


def dedupe_run(spark, source, out, delay):
    events = read_stream(
        spark, "parquet", spark.createDataFrame([], "id int, ts timestamp, n int").schema, source
    )
    query = (
        stream_dedupe(events, ["id"], "ts", delay)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/ck")
        .trigger(availableNow=True)
        .start(f"{out}/rows")
    )
    query.awaitTermination()
    return sorted(tuple(row) for row in spark.read.parquet(f"{out}/rows").select("id", "n").collect())


def test_event_dedupe_across_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    start = datetime(2024, 1, 1)

    def send(*rows):
        parsed = [(i, start + timedelta(minutes=m), n) for i, m, n in rows]
        frame = spark.createDataFrame(parsed, "id int, ts timestamp, n int")
        frame.coalesce(1).write.mode("append").parquet(source)

    send((1, 0, 1), (2, 1, 1))
    assert dedupe_run(spark, source, out, "10 minutes") == [(1, 1), (2, 1)]
    # A replay in a later run is dropped: the first row wins.
    send((1, 2, 2), (3, 3, 1))
    assert dedupe_run(spark, source, out, "10 minutes") == [(1, 1), (2, 1), (3, 1)]
