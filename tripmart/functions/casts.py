"""Casts that give NULL for bad input whether or not ANSI mode is on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_int(value: Column, source_type: T.DataType) -> Column:
    """Integer or NULL. A string such as ``"2.0"`` counts as 2."""
    plain = value.try_cast("int")
    if not isinstance(source_type, T.StringType):
        return plain
    # The pattern is only matched against what is not a plain integer.
    whole = F.regexp_replace(F.trim(value), r"^([+-]?\d+)\.\d*$", "$1")
    return F.coalesce(plain, whole.try_cast("int"))


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_time(value: Column, source_type: T.DataType) -> Column:
    """Timestamp or NULL."""
    if isinstance(source_type, T.StringType):
        return F.try_to_timestamp(value)
    return value.cast("timestamp")
