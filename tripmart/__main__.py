"""The jobs, as commands.

    python -m tripmart bronze --history PATH --kafka BROKER [--forever]
    python -m tripmart silver --zones CSV [--incremental]
    python -m tripmart dq
    python -m tripmart gold [--incremental]
    python -m tripmart run --zones CSV [--history PATH] [--kafka BROKER]
    python -m tripmart compact TABLE --by COLUMN ...
    python -m tripmart compact bronze/trips

Options default to the environment: ``S3_BUCKET``, ``HISTORICAL_SOURCE_PATH``,
``KAFKA_BROKER``, ``KAFKA_TOPIC`` and ``RUN_MODE``. ``silver`` and ``gold`` end quietly
while their input does not exist; ``dq`` and ``run`` exit with 1 if a check fails.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.checks import QualityError
from tripmart.plans.audit import run_dq
from tripmart.plans.bronze import SEED, read_bronze, run_bronze
from tripmart.plans.gold import run_gold
from tripmart.plans.medallion import LakeConfig, run_pipeline
from tripmart.plans.silver import refresh_silver, run_silver
from tripmart.session import build_session
from tripmart.sinks.tables import TRANSACTIONAL, compact, compact_origin, drop_old_versions
from tripmart.sources.tables import read_stream, read_table, read_zones
from tripmart.streaming.landing import LIVE

log = logging.getLogger("tripmart")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    bucket = os.getenv("S3_BUCKET")
    common.add_argument(
        "--root", default=f"s3a://{bucket}" if bucket else None, required=not bucket
    )
    common.add_argument("--mode", choices=["local", "cloud"], default=None)
    common.add_argument("--format", default="parquet")
    common.add_argument("--master", default=None)
    common.add_argument("--run-id", default=None)

    inputs = argparse.ArgumentParser(add_help=False)
    inputs.add_argument("--history", default=os.getenv("HISTORICAL_SOURCE_PATH"))
    inputs.add_argument("--kafka", default=os.getenv("KAFKA_BROKER"))
    inputs.add_argument("--topic", default=os.getenv("KAFKA_TOPIC", "trips.live"))
    inputs.add_argument(
        "--max-offsets", default="5000000", help="records of the topic in one micro-batch"
    )

    parser = argparse.ArgumentParser(prog="tripmart", description="Trip lakehouse jobs.")
    jobs = parser.add_subparsers(dest="job", required=True)
    bronze = jobs.add_parser("bronze", parents=[common, inputs])
    bronze.add_argument("--forever", action="store_true", help="keep reading the stream")
    silver = jobs.add_parser("silver", parents=[common])
    silver.add_argument("--zones", required=True)
    silver.add_argument("--incremental", action="store_true")
    jobs.add_parser("dq", parents=[common])
    gold = jobs.add_parser("gold", parents=[common])
    gold.add_argument("--incremental", action="store_true")
    run = jobs.add_parser("run", parents=[common, inputs])
    run.add_argument("--zones", required=True)
    run.add_argument("--incremental", action="store_true")
    compaction = jobs.add_parser("compact", parents=[common])
    compaction.add_argument("table", help="path below the root, such as silver/trips")
    compaction.add_argument("--by", nargs="+", default=[], help="columns to sort by")
    compaction.add_argument("--keep", type=int, default=1, help="old versions to keep")
    return parser.parse_args(argv)


def _stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    if not args.kafka:
        return None
    options = {
        "kafka.bootstrap.servers": args.kafka,
        "subscribe": args.topic,
        "maxOffsetsPerTrigger": args.max_offsets,
    }
    return read_stream(spark, "kafka", **options)


def _job(spark: SparkSession, args: argparse.Namespace, run_id: str) -> int:
    cfg = LakeConfig(root=args.root, zones=None, fmt=args.format)
    if args.job == "bronze":
        trigger = {"processingTime": "30 seconds"} if args.forever else None
        run_bronze(
            spark,
            cfg.bronze_path,
            args.history,
            _stream(spark, args),
            cfg.checkpoint_path,
            trigger=trigger,
            fmt=args.format,
        )
        return 0
    if args.job == "run":
        cfg.zones = read_zones(spark, args.zones)
        cfg.history_path, cfg.stream = args.history, _stream(spark, args)
        cfg.incremental = args.incremental
        if run_pipeline(spark, cfg, run_id) is None:
            log.info("no bronze table yet")
        return 0
    if args.job == "compact":
        path = cfg.path(args.table)
        if path.rstrip("/") == cfg.bronze_path:
            for origin in (SEED, LIVE):
                compact_origin(spark, path, origin, run_id, fmt=args.format)
            return 0
        if not args.by:
            log.error("name the columns to sort by")
            return 2
        compact(spark, path, run_id, args.by, fmt=args.format)
        drop_old_versions(spark, path, args.keep)
        return 0
    if args.job == "silver":
        bronze = read_bronze(spark, cfg.bronze_path, args.format)
        if bronze is None:
            log.info("no bronze table yet")
            return 0
        zones = read_zones(spark, args.zones)
        if args.incremental and args.format not in TRANSACTIONAL:
            change = refresh_silver(spark, cfg.bronze_path, zones, cfg.silver_path, run_id, fmt=args.format)
            change.publish(spark, cfg.silver_path)
        else:
            run_silver(bronze, zones, cfg.silver_path, run_id, fmt=args.format)
        return 0

    silver = read_table(spark, cfg.silver_path, args.format, missing="none")
    if args.job == "gold":
        if silver is None:
            log.info("no silver table yet")
            return 0
        run_gold(
            spark, silver, cfg.gold_path, run_id, args.format, args.incremental, silver_path=cfg.silver_path
        )
        return 0
    if silver is None:
        log.error("no silver table to check")
        return 1
    run_dq(silver)
    log.info("quality checks passed")
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = _arguments(argv)
    if spark is None:
        spark = build_session(f"tripmart-{args.job}", args.mode, args.format, args.master)
    try:
        return _job(spark, args, args.run_id or uuid.uuid4().hex)
    except QualityError as error:
        for failure in error.failures:
            log.error("failed check: %s", failure)
        return 1


if __name__ == "__main__":
    sys.exit(main())
