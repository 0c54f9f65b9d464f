"""Serving aggregates kept as partial states, which an upsert changes only where it touches rows.

A state holds, per pickup date partition and key of the aggregate, counts and sums. Sums are in
fixed point where the resolution of a measure is known (see `totals`), so that states add up to
the same bits in any order. An aggregate is its states summed over the partitions; a refresh reads
and replaces the states of touched partitions only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.metrics import hour_label, pickup_partition
from tripmart.schemas import PARTITION_UNIT, PICKUP_DATE
from tripmart.sinks.tables import (
    current_parts,
    load_partitions,
    load_published,
    notes_of,
    overwrite,
    publish,
    published,
    replace_partitions,
)

Resolutions = Mapping[str, int]


@dataclass(frozen=True)
class Rollup:
    """One aggregate: keys as SQL over the trips, and measures by their output names."""

    name: str
    keys: dict[str, str]
    count: str
    totals: dict[str, str] = field(default_factory=dict)
    means: dict[str, str] = field(default_factory=dict)
    labels: Callable[[], dict[str, Column]] = dict

    @property
    def measures(self) -> list[str]:
        return sorted({*self.totals.values(), *self.means.values()})


DAILY = Rollup(
    "agg_daily_revenue",
    {"day": "to_date(tpep_pickup_datetime)", "vendor_id": "vendor_id"},
    "total_trips",
    {"total_revenue": "total_amount"},
    {"avg_fare": "fare_amount", "avg_distance": "trip_distance"},
    lambda: {"trip_date": F.date_format("day", "yyyy-MM-dd"), "vendor_id": F.col("vendor_id")},
)
HOURLY = Rollup(
    "agg_hourly_demand",
    {
        "day": "to_date(tpep_pickup_datetime)",
        "hour": "hour(tpep_pickup_datetime)",
        "pickup_h3": "pickup_h3",
        "pickup_zone": "pickup_zone",
    },
    "trip_count",
    {},
    {"avg_fare": "fare_amount", "avg_trip_duration_minutes": "trip_duration_minutes"},
    lambda: {
        "pickup_hour": hour_label(F.col("day"), F.col("hour")),
        "pickup_h3": F.col("pickup_h3"),
        "pickup_zone": F.col("pickup_zone"),
    },
)
HEATMAP = Rollup(
    "agg_demand_heatmap",
    {"pickup_h3": "pickup_h3"},
    "trip_count",
    {},
    {"avg_fare": "fare_amount", "avg_trip_duration_minutes": "trip_duration_minutes"},
    lambda: {"pickup_h3": F.col("pickup_h3")},
)
ROLLUPS = [DAILY, HOURLY, HEATMAP]


def _units(measure: str, resolutions: Resolutions) -> Column:
    value = F.col(measure)
    if measure not in resolutions:
        return value.cast("double")
    return F.floor(value * F.lit(float(resolutions[measure])) + F.lit(0.5))


def states_of(
    rollup: Rollup,
    trips: DataFrame,
    resolutions: Resolutions | None = None,
    unit: str = PARTITION_UNIT,
) -> DataFrame:
    """States of ``trips``: one row per date partition and key."""
    res = resolutions or {}
    if PICKUP_DATE not in trips.columns:
        trips = trips.withColumn(PICKUP_DATE, pickup_partition(F.col("tpep_pickup_datetime"), unit))
    keys = [F.expr(text).alias(name) for name, text in rollup.keys.items()]
    parts = [F.count("trip_id").alias("trips")]
    for measure in rollup.measures:
        parts += [
            F.sum(_units(measure, res)).alias(f"{measure}_sum"),
            F.count(measure).alias(f"{measure}_n"),
        ]
    return trips.groupBy(PICKUP_DATE, *keys).agg(*parts)


def merged(rollup: Rollup, states: DataFrame, resolutions: Resolutions | None = None) -> DataFrame:
    """The aggregate out of its states, with the columns it has when made in one go."""
    res = resolutions or {}
    sums = [F.sum("trips").alias(rollup.count)]
    for measure in rollup.measures:
        sums += [F.sum(f"{measure}_{part}").alias(f"{measure}_{part}") for part in ("sum", "n")]
    whole = states.groupBy(*rollup.keys).agg(*sums)

    def amount(measure: str) -> Column:
        units = F.col(f"{measure}_sum")
        return units.cast("double") / F.lit(float(res[measure])) if measure in res else units

    return whole.select(
        *(column.alias(name) for name, column in rollup.labels().items()),
        rollup.count,
        *(amount(measure).alias(name) for name, measure in rollup.totals.items()),
        *(
            (amount(measure) / F.nullif(F.col(f"{measure}_n"), F.lit(0))).alias(name)
            for name, measure in rollup.means.items()
        ),
    )


def refresh(
    spark: SparkSession,
    rollup: Rollup,
    source: str,
    path: str,
    run_id: str,
    touched: Sequence[object] | None = None,
    follows: str | None = None,
    resolutions: Resolutions | None = None,
    fmt: str = "parquet",
    publish_now: bool = True,
) -> dict[str, str] | None:
    """Bring the states at ``path`` up to the published version of the table at ``source``.

    ``touched`` are the date partitions in which the source differs from its version ``follows``.
    Only they are read, and only their states are written; all other states stay the files they
    are. States that stand at the published version stay; where they do not stem from ``follows``
    (or with ``touched`` None) all of the source is read. Publishes, and returns, the states' parts (None after a full build).
    """
    of = {"of": published(spark, source)}
    base = published(spark, path)
    stands_at = notes_of(spark, path).get("of")
    if base is not None and stands_at == of["of"]:
        return current_parts(spark, path)
    if base is None or touched is None or stands_at != follows:
        states = states_of(rollup, load_published(spark, source, fmt), resolutions)
        overwrite(states, path, run_id, fmt, [PICKUP_DATE], publish_now=False)
        if publish_now:
            publish(spark, path, run_id, base, notes=of)
        return None
    rows = load_partitions(spark, source, PICKUP_DATE, touched, fmt)
    if rows is None:
        # every touched partition is gone: so are its states
        rows = load_published(spark, source, fmt).limit(0)
    states = states_of(rollup, rows, resolutions)
    return replace_partitions(states, path, run_id, PICKUP_DATE, touched, fmt, publish_now, of)
