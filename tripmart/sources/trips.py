"""From a raw trip file to the trip record: names, types, defaults and an identifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.casts import to_double, to_int
from tripmart.schemas import TRIP_COLUMNS, TRIP_SCHEMA
from tripmart.sources.tables import scan_history

# Column names of the raw file that differ from the trip record.
RAW_NAMES = {"VendorID": "vendor_id", "Airport_fee": "airport_fee"}

# What makes two rows of a raw file the same trip: everything that is known of it.
NATURAL_KEY = [name for name in TRIP_COLUMNS if name != "trip_id"]


def _trip_field(df: DataFrame, field: T.StructField) -> Column:
    present = field.name in df.columns
    value = F.col(field.name) if present else F.lit(None)
    source_type = df.schema[field.name].dataType if present else T.NullType()
    if isinstance(field.dataType, T.IntegerType):
        value = to_int(value, source_type)
    elif isinstance(field.dataType, T.DoubleType):
        value = to_double(value)
    else:
        value = value.cast(field.dataType)
    if not field.nullable and isinstance(field.dataType, (T.IntegerType, T.DoubleType)):
        value = F.coalesce(value, F.lit(0).cast(field.dataType))
    return value.alias(field.name)


def normalize_trips(
    df: DataFrame, limit: int | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Rename, cast and default a raw trip file to the trip record.

    Required numbers default to 0, optional ones stay NULL, times become strings.
    ``limit`` keeps the first rows in the order of ``order_by`` (see `first_trips`).
    """
    df = df.withColumnsRenamed(RAW_NAMES)
    if limit is not None:
        df = first_trips(df, limit, order_by)
    fields = [f for f in TRIP_SCHEMA if f.name != "trip_id" or "trip_id" in df.columns]
    return df.select(*[_trip_field(df, f) for f in fields])


def first_trips(df: DataFrame, limit: int, order_by: Sequence[str] | None) -> DataFrame:
    """The first ``limit`` rows; a distributed file has no order of its own, so one is named."""
    if not order_by:
        raise ValueError("a row limit needs order_by: files have no row order on a cluster")
    return df.orderBy(*order_by).limit(limit)


def surrogate_trip_id(
    df: DataFrame, natural_key: Sequence[str] = tuple(NATURAL_KEY)
) -> DataFrame:
    """Put ``trip_id`` first, a digest of the natural key: the same row always gets the same id."""
    # A NULL must not vanish from the digest input, or (a, NULL, b) would equal (a, b, NULL).
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("\\N")) for name in natural_key]
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    rest = [name for name in df.columns if name != "trip_id"]
    return df.select(F.concat(F.lit("trip_"), digest).alias("trip_id"), *rest)


def read_history(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Historical file as it is, under the names of the trip record, with ids if it has none.

    Values keep their types, unreadable and missing ones too, and columns beyond the trip
    record stay: this is what bronze holds. An id is a digest over all columns of the file.
    """
    raw = scan_history(spark, path)
    if raw is None:
        return None
    trips = raw.withColumnsRenamed(RAW_NAMES)
    if "trip_id" not in trips.columns:
        known = [name for name in NATURAL_KEY if name in trips.columns]
        others = sorted(name for name in trips.columns if name not in known)
        trips = surrogate_trip_id(trips, [*known, *others])
    return trips
