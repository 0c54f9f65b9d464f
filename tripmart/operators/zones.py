"""Zone attributes of both ends of a trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.cells import hex_cell
from tripmart.functions.globe import globe_cell
from tripmart.operators.dedupe import first_per_key
from tripmart.operators.lookup import fits_broadcast, lookup_join
from tripmart.schemas import SILVER_KEY

ZONE_ATTRIBUTES = ["zone_name", "borough", "lat", "lon"]


# Grids of `zone_cells`: planar cells hold at city scale, those of the globe anywhere.
GRIDS = {"city": hex_cell, "globe": globe_cell}


def zone_cells(zones: DataFrame, res: int = 9, grid: str = "city") -> DataFrame:
    """Zone lookup with its ``cell``, computed once per zone rather than once per trip."""
    if grid not in GRIDS:
        raise ValueError(f"unknown grid {grid!r}: expected one of {sorted(GRIDS)}")
    return zones.withColumn("cell", GRIDS[grid](F.col("lat"), F.col("lon"), res))


def _one_row_per_zone(zones: DataFrame) -> DataFrame:
    order = [F.col(name).asc_nulls_last() for name in [*ZONE_ATTRIBUTES, "cell"]]
    listed = zones.select("LocationID", *ZONE_ATTRIBUTES, "cell").filter(F.col("LocationID").isNotNull())
    return first_per_key(listed, ["LocationID"], order)


def enrich_zones(
    trips: DataFrame,
    zones: DataFrame,
    cell_col: str | None = None,
    grid: str = "city",
    small: bool | None = None,
) -> DataFrame:
    """Add zone, borough, position and cell of pickup and dropoff.

    Trips without a known zone stay, with NULLs. A zone listed twice does not double its
    trips. ``cell_col`` names a column of ``zones`` to use in place of the computed cell, ``grid``
    the grid it is computed on. Pass ``small`` to reuse a measurement of ``zones``.
    """
    # Measured before the rows are made unique, which only makes them fewer.
    small = fits_broadcast(zones) if small is None else small
    if cell_col is None:
        zones = zone_cells(zones, grid=grid)
    else:
        zones = zones.withColumn("cell", F.col(cell_col))
    zones = _one_row_per_zone(zones)

    pickup = zones.select(
        F.col("LocationID").alias("PULocationID"),
        F.col("zone_name").alias("pickup_zone"),
        F.col("borough").alias("pickup_borough"),
        F.col("lat").alias("pu_lat"),
        F.col("lon").alias("pu_lon"),
        F.col("cell").alias("pickup_h3"),
    )
    dropoff = zones.select(
        F.col("LocationID").alias("DOLocationID"),
        F.col("zone_name").alias("dropoff_zone"),
        F.col("borough").alias("dropoff_borough"),
        F.col("lat").alias("do_lat"),
        F.col("lon").alias("do_lon"),
        F.col("cell").alias("dropoff_h3"),
    )
    trips = lookup_join(trips, pickup, "PULocationID", SILVER_KEY, small)
    return lookup_join(trips, dropoff, "DOLocationID", SILVER_KEY, small)
