"""The two check suites of the silver table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from tripmart.operators.checks import Check, evaluate, gate
from tripmart.schemas import SILVER_KEY

# Limits and patterns the silver table is held to.
PASSENGER_RANGE = (0, 10)
FARE_RANGE = (0, 1000)
DURATION_RANGE = (0, 360)
CELL_PATTERN = "^[0-9a-f]{15}$"
FARE_CEILING = 5000
DECLARED_TYPES = {
    "trip_id": "string",
    "fare_amount": "double",
    "tpep_pickup_datetime": "timestamp",
}


def silver_suite() -> list[Check]:
    """Row-level expectations of the gate before gold."""
    return [
        Check("row_count", above=0),
        Check("exists", "trip_id"),
        Check("exists", "vendor_id"),
        Check("not_null", "tpep_pickup_datetime"),
        Check("not_null", "pickup_h3"),
        Check("between", "passenger_count", low=PASSENGER_RANGE[0], high=PASSENGER_RANGE[1]),
        Check("between", "fare_amount", low=FARE_RANGE[0], high=FARE_RANGE[1]),
        Check("between", "trip_duration_minutes", low=DURATION_RANGE[0], high=DURATION_RANGE[1]),
        Check("regex", "pickup_h3", pattern=CELL_PATTERN),
        Check("unique", SILVER_KEY),
    ]


def schema_suite() -> list[Check]:
    return [Check("type", name, type=text) for name, text in DECLARED_TYPES.items()]


def metric_suite() -> list[Check]:
    """Whole-table metrics."""
    return [
        Check("row_count", above=0),
        Check("not_null", "trip_id"),
        Check("duplicates", "trip_id"),
        Check("minimum", "fare_amount", low=0),
        Check("maximum", "fare_amount", below=FARE_CEILING),
    ]


def table_suite() -> list[Check]:
    return metric_suite() + schema_suite()


def run_dq(silver: DataFrame, suite: list[Check] | None = None) -> list[dict[str, Any]]:
    """Check silver; raises `QualityError` if a check fails."""
    return gate(evaluate(silver, suite if suite is not None else silver_suite()))
