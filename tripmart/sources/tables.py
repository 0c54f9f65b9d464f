"""Scans: historical files, the zone lookup, lake tables, and the trip stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart import paths
from tripmart.schemas import ZONE_FILE_SCHEMA
from tripmart.sinks.drift import scan_drifting
from tripmart.sinks.tables import TRANSACTIONAL, MissingTable, load_published

# Error conditions of a table that is not there, of Spark and of the optional format.
MISSING_TABLE_CONDITIONS = {
    "PATH_NOT_FOUND",
    "TABLE_OR_VIEW_NOT_FOUND",
    "DELTA_TABLE_NOT_FOUND",
    "DELTA_PATH_DOES_NOT_EXIST",
    "DELTA_MISSING_DELTA_TABLE",
}


def scan_history(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Historical Parquet as it is, with ``trip_id`` as a string; ``None`` without a path.

    Files of one folder may differ in columns and types: every column of any file is there, as wide
    as the widest (see `drift`). All footers are opened, no row group is.
    """
    if not path:
        return None
    df = scan_drifting(spark, path)
    if "trip_id" in df.columns:
        df = df.withColumn("trip_id", F.col("trip_id").cast("string"))
    return df


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV: ``LocationID, zone_name, borough, lat, lon``."""
    raw = spark.read.option("header", True).schema(ZONE_FILE_SCHEMA).csv(path)
    return raw.select(
        F.col("LocationID").try_cast("int").alias("LocationID"),
        F.col("Zone").alias("zone_name"),
        F.col("Borough").alias("borough"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
    )


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    missing: str = "error",
    schema: StructType | None = None,
) -> DataFrame | None:
    """Read the published version of a table.

    ``missing="none"`` turns a table that is not there yet into ``None``; any other
    failure is raised. A ``schema`` fills columns that older files lack with NULL
    without opening every footer, as schema merging would.
    """
    if missing not in ("error", "none"):
        raise ValueError(f"missing must be 'error' or 'none', not {missing!r}")
    try:
        if fmt in TRANSACTIONAL:
            reader = spark.read.format(fmt)
            return (reader.schema(schema) if schema is not None else reader).load(path)
        return load_published(spark, path, fmt, schema)
    except MissingTable:
        if missing == "none":
            return None
        raise
    except AnalysisException as error:
        if missing == "none" and error.getCondition() in MISSING_TABLE_CONDITIONS:
            return None
        raise


def read_stream(
    spark: SparkSession,
    fmt: str,
    schema: StructType | None = None,
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Open a stream.

    ``kafka`` reads from the earliest offset unless ``startingOffsets`` says otherwise;
    bound a micro-batch with ``maxOffsetsPerTrigger``. File formats need a ``schema``;
    ``path`` may be a directory or one file.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
    if path is not None and not paths.is_directory(spark, path):
        path, _, name = path.rpartition("/")
        options = {"pathGlobFilter": name, **options}
    reader = reader.options(**options)
    return reader.load(path) if path is not None else reader.load()


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for use in ``spark.sql`` and ``spark.table``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
