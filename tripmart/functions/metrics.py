"""Per-trip measures and time labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(pickup: Column, dropoff: Column) -> Column:
    """Whole seconds between the two times, in minutes."""
    return (F.unix_seconds(dropoff) - F.unix_seconds(pickup)) / F.lit(60.0)


def fare_per_mile(fare: Column, distance: Column) -> Column:
    """NULL unless the distance is positive."""
    return F.when(distance > 0, fare / distance)


def hour_label(day: Column, hour: Column) -> Column:
    """``yyyy-MM-dd HH:00:00`` from a date and an hour of the day."""
    clock = F.lpad(hour.cast("string"), 2, "0")
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), clock, F.lit(":00:00"))


def pickup_partition(pickup: Column, unit: str) -> Column:
    """First day of the ``unit`` (day, month, quarter, year) that holds a pickup."""
    return F.to_date(pickup) if unit == "day" else F.trunc(pickup, unit)
