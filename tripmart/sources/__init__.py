from tripmart.sources.tables import (
    read_stream,
    read_table,
    read_zones,
    register,
    scan_history,
)
from tripmart.sources.trips import first_trips, normalize_trips, read_history, surrogate_trip_id

__all__ = [
    "first_trips",
    "normalize_trips",
    "read_history",
    "read_stream",
    "read_table",
    "read_zones",
    "register",
    "scan_history",
    "surrogate_trip_id",
]
