from tripmart.operators.checks import Check, QualityError, evaluate, gate, orphans, orphans_of
from tripmart.operators.clean import trip_metrics, type_trips, valid_trips
from tripmart.operators.dedupe import latest_per_key
from tripmart.operators.lookup import lookup_join
from tripmart.operators.upsert import upsert_incremental, upsert_partitions
from tripmart.operators.zones import enrich_zones, zone_cells

__all__ = [
    "Check",
    "QualityError",
    "enrich_zones",
    "evaluate",
    "gate",
    "latest_per_key",
    "lookup_join",
    "orphans",
    "orphans_of",
    "trip_metrics",
    "type_trips",
    "upsert_incremental",
    "upsert_partitions",
    "valid_trips",
    "zone_cells",
]
