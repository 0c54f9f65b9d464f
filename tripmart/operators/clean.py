"""Typing, filtering and measuring trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.casts import to_double, to_int, to_time
from tripmart.functions.metrics import duration_minutes, fare_per_mile
from tripmart.schemas import DOUBLE_COLUMNS, INT_COLUMNS, TIME_COLUMNS


def type_trips(df: DataFrame) -> DataFrame:
    """Coerce codes, amounts and times; what cannot be read becomes NULL."""
    types = {f.name: f.dataType for f in df.schema}
    typed = {name: to_int(F.col(name), types[name]) for name in INT_COLUMNS}
    typed |= {name: to_double(F.col(name)) for name in DOUBLE_COLUMNS}
    typed |= {name: to_time(F.col(name), types[name]) for name in TIME_COLUMNS}
    return df.withColumns(typed)


def trip_metrics(df: DataFrame) -> DataFrame:
    """Add ``trip_duration_minutes`` and ``fare_per_mile``."""
    return df.withColumns(
        {
            "trip_duration_minutes": duration_minutes(
                F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
            ),
            "fare_per_mile": fare_per_mile(F.col("fare_amount"), F.col("trip_distance")),
        }
    )


def valid_trips(df: DataFrame) -> DataFrame:
    """Trips whose fare and duration are known and not negative."""
    duration = duration_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return df.filter((F.col("fare_amount") >= 0) & (duration >= 0))
