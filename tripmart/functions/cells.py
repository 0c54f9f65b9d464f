"""Hexagonal grid cells as plain column expressions.

The ids have the shape of a 15-digit hexadecimal cell index and the same NULL rules,
but they are not indexes of any published global grid: the grid is planar around a
reference latitude and holds at city scale.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres per degree at 40.7 degrees north.
METRES_PER_LAT = 111195.0
METRES_PER_LON = 84300.0

# Edge of a cell at resolution 9; each finer resolution divides the area by seven.
EDGE_AT_9 = 200.0

# Axial coordinates of a pointy-top hexagon: sqrt(3)/3, 1/3 and 2/3.
SQRT3_THIRD = 0.5773502691896257
TWO_THIRDS = 0.6666666666666666

AXIS_OFFSET = 2**27
AXIS_SPAN = 2**28


def edge_metres(res: int, edge_m: float = EDGE_AT_9) -> float:
    return edge_m * math.sqrt(7.0) ** (9 - res)


def hex_cell(lat: Column, lon: Column, res: int = 9, edge_m: float = EDGE_AT_9) -> Column:
    """Cell id of a point.

    NULL if a coordinate is NULL, not a number, off the globe, or exactly zero (the
    mark of a missing position).
    """
    if not 0 <= res <= 15:
        raise ValueError(f"resolution must lie in 0..15, not {res}")
    edge = edge_metres(res, edge_m)
    lat, lon = lat.try_cast("double"), lon.try_cast("double")
    north = lat * F.lit(METRES_PER_LAT)
    east = lon * F.lit(METRES_PER_LON)

    x = (F.lit(SQRT3_THIRD) * east - north / F.lit(3.0)) / F.lit(edge)
    z = (F.lit(TWO_THIRDS) * north) / F.lit(edge)
    y = -x - z

    # Round all three cube coordinates, then restore x + y + z = 0 by replacing the
    # one that moved most. y only decides which of the other two is replaced.
    rx, ry, rz = (F.floor(v + F.lit(0.5)) for v in (x, y, z))
    dx, dy, dz = (F.abs(r - v) for r, v in ((rx, x), (ry, y), (rz, z)))
    q = F.when((dx > dy) & (dx > dz), -ry - rz).otherwise(rx)
    r = F.when((dx > dy) & (dx > dz), rz).when(dy > dz, rz).otherwise(-rx - ry)

    packed = (
        F.lit(res * AXIS_SPAN * AXIS_SPAN)
        + (q + F.lit(AXIS_OFFSET)) * F.lit(AXIS_SPAN)
        + (r + F.lit(AXIS_OFFSET))
    )
    on_globe = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    located = on_globe & (lat != 0.0) & (lon != 0.0)
    return F.when(located, F.lpad(F.lower(F.hex(packed)), 15, "0"))
