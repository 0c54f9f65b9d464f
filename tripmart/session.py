"""Session construction and the few session facts the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Extension and catalog classes that switch on the optional table format.
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}

# What tables and results depend on. Timestamps are formatted and parsed in the session time
# zone, and only this timestamp type carries the statistics that let a filter on ingest or
# pickup time skip row groups.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# What every session of the library has, whoever built it: tables between steps are as small as
# the published ones.
TABLE_CONF = {"spark.sql.parquet.compression.codec": "zstd"}

# HotSpot leaves a method of more bytecode than this to its interpreter. A stage whose generated
# code has one, as the decoding of wide records has, runs as separate operators, which are compiled.
CODE_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Fixed value: the state store that keeps dedupe state on disk rather than on the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str,
    mode: str | None = None,
    table_format: str = "parquet",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build the session every job uses.

    ``mode`` is ``local`` (an S3-compatible store at ``S3_ENDPOINT``) or ``cloud``
    (the store's own defaults); it defaults to ``RUN_MODE``. Credentials are read
    from the standard provider chain or the environment, never from code. Sizing
    (executors, memory, shuffle partitions) belongs to ``spark-submit`` or ``conf``.
    """
    mode = mode or os.getenv("RUN_MODE", "local")
    if mode not in ("local", "cloud"):
        raise ValueError(f"unknown mode {mode!r}: expected 'local' or 'cloud'")

    settings = {
        **RUNTIME_CONF,
        **TABLE_CONF,
        **CODE_CONF,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        # Published version directories rely on the rename-on-commit algorithm.
        "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version": "1",
    }
    if table_format == "delta":
        settings.update(DELTA_CONF)
    if mode == "local" and os.getenv("S3_ENDPOINT"):
        settings["spark.hadoop.fs.s3a.endpoint"] = os.environ["S3_ENDPOINT"]
        settings["spark.hadoop.fs.s3a.path.style.access"] = "true"
    settings.update(conf or {})

    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare_session(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the settings results, tables and compiled code depend on."""
    for key, value in (RUNTIME_CONF | TABLE_CONF | CODE_CONF).items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local-mode session may fall back to a temporary folder, since there the
    driver and the executors are one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "tripmart")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/tripmart/{name}-{uuid.uuid4().hex}"
