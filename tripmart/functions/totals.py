"""Sums and means of doubles, plain or in fixed point.

A double sum depends on the order of its terms, so a retried task can change its last
bits. Where the values are finite and known to be multiples of ``1 / resolution`` (cents: 100,
whole seconds kept in minutes: 60), summing the multiples as integers is exact, does not
depend on partitioning, and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(value: Column, resolution: int | None = None) -> Column:
    if resolution is None:
        return F.sum(value)
    units = F.floor(value * F.lit(float(resolution)) + F.lit(0.5))
    return F.sum(units).cast("double") / F.lit(float(resolution))


def mean(value: Column, resolution: int | None = None) -> Column:
    if resolution is None:
        return F.avg(value)
    # A group of NULLs only has no mean; ANSI division by its zero count would raise.
    return total(value, resolution) / F.nullif(F.count(value), F.lit(0))
