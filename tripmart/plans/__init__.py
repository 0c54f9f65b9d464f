from tripmart.plans.audit import run_dq, silver_suite, table_suite
from tripmart.plans.bronze import bronze_union, read_bronze, run_bronze
from tripmart.plans.gold import (
    daily_revenue,
    demand_heatmap,
    dim_payment,
    dim_zone,
    fact_trips,
    hourly_demand,
    run_gold,
    star_revenue,
    zone_tuples,
)
from tripmart.plans.medallion import LakeConfig, run_pipeline
from tripmart.plans.silver import clean_trips, run_silver, silver_trips

__all__ = [
    "LakeConfig",
    "bronze_union",
    "clean_trips",
    "daily_revenue",
    "demand_heatmap",
    "dim_payment",
    "dim_zone",
    "fact_trips",
    "hourly_demand",
    "read_bronze",
    "run_bronze",
    "run_dq",
    "run_gold",
    "run_pipeline",
    "run_silver",
    "silver_suite",
    "silver_trips",
    "star_revenue",
    "table_suite",
    "zone_tuples",
]
