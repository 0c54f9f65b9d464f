"""The grid of the globe: areas, hierarchy, neighbours."""

import cmath
import math
import random

import pytest
from pyspark.sql import functions as F

from tripmart.functions.globe import COARSEST_CELLS, bases, faces, globe_cell, globe_center, globe_neighbours, globe_parent

LATITUDES = [-85, -67, -48, -29, -10, 10, 29, 48, 67, 85]


def points(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(LATITUDES[i % 10] + rng.uniform(-4, 4), rng.uniform(-180, 180)) for i in range(n)]
    return spark.createDataFrame(rows, "lat double, lon double")


def sphere(lat, lon):
    a, b = math.radians(lat), math.radians(lon)
    return (math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a))


def angle(p, q):
    return math.acos(max(-1, min(1, sum(x * y for x, y in zip(p, q, strict=True)))))


def test_faces_are_regular():
    all_faces = faces()
    assert len(all_faces) == 20
    for c, e, n in all_faces:
        for x, y in ((c, e), (c, n), (e, n)):
            assert abs(sum(i * j for i, j in zip(x, y, strict=True))) < 1e-12
        near = sorted(angle(c, o) for o, _, _ in all_faces)[1:4]
        assert max(near) - min(near) < 1e-9


@pytest.mark.parametrize("res", [0, 3, 9, 15])
def test_a_point_lies_near_the_centre_of_its_cell(spark, res):
    found = points(spark).withColumn("cell", globe_cell(F.col("lat"), F.col("lon"), res))
    found = found.withColumn("c", globe_center(F.col("cell"))).collect()
    radius = abs(bases()[res]) / math.sqrt(3)
    for r in found:
        assert len(r.cell) == 15 and int(r.cell, 16) >> 55 == res
        # the projection stretches by at most 6 % within a face
        assert angle(sphere(r.lat, r.lon), sphere(r.c.lat, r.c.lon)) <= radius * 1.08 + 1e-9


def test_cells_have_one_area_at_every_latitude(spark):
    """Shares of random points per cell, and the exact area of the cells' hexagons."""
    res = 6
    found = points(spark).select(globe_cell(F.col("lat"), F.col("lon"), res).alias("cell")).collect()
    step, all_faces = bases()[res], faces()
    areas = []
    for (cell,) in found:
        packed = int(cell, 16)
        face, q, r = packed >> 50 & 31, (packed >> 25 & 2**25 - 1) - 2**24, (packed & 2**25 - 1) - 2**24
        centre = (q - r * cmath.exp(2j * math.pi / 3)) * step
        corners = [centre + step / math.sqrt(3) * cmath.exp(1j * math.pi * (k / 3 + 1 / 6)) for k in range(6)]

        def lift(z, face=face):
            c, e, n = all_faces[face]
            d, s = 1 - abs(z) ** 2 / 2, math.sqrt(1 - abs(z) ** 2 / 4)
            return tuple(c[i] * d + s * (e[i] * z.real + n[i] * z.imag) for i in range(3))

        # many sides, as straight lines of the plane are no great circles
        ring = [corners[k] + (corners[(k + 1) % 6] - corners[k]) * t / 20 for k in range(6) for t in range(20)]
        mid, ring = lift(centre), [lift(z) for z in ring]
        total = 0.0
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            cross = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
            triple = sum(x * y for x, y in zip(mid, cross, strict=True))
            dots = 1 + sum(x * y for x, y in zip(a, b, strict=True)) + sum(x * y for x, y in zip(b, mid, strict=True)) + sum(x * y for x, y in zip(mid, a, strict=True))
            total += 2 * math.atan2(abs(triple), dots)
        areas.append(total)
    assert max(areas) / min(areas) < 1.001
    assert abs(areas[0] - 4 * math.pi / COARSEST_CELLS / 7**res) < areas[0] * 1e-3


def test_seven_children(spark):
    """Around a point inside a face: 49 cells of two levels below belong to one, seven each."""
    inside = spark.createDataFrame([(40.7, -74.0)], "lat double, lon double")
    start = inside.select(globe_cell(F.col("lat"), F.col("lon"), 5).alias("cell")).first().cell
    cells = {start}
    for _ in range(12):
        df = spark.createDataFrame([(c,) for c in cells], "cell string")
        cells |= {n for r in df.select(globe_neighbours(F.col("cell")).alias("n")).collect() for n in r.n}
    df = spark.createDataFrame([(c,) for c in cells], "cell string").select("cell", globe_parent(F.col("cell")).alias("parent"))
    df = df.withColumn("grand", globe_parent(F.col("parent")))
    whole = {r.parent: r.n for r in df.groupBy("parent").agg(F.count("*").alias("n")).collect()}
    assert len(cells) == 1 + 6 * sum(range(1, 13)) and max(whole.values()) == 7
    assert sum(n == 7 for n in whole.values()) > 40
    grand = df.select("parent", "grand").distinct().groupBy("grand").agg(F.count("*").alias("n")).collect()
    assert max(r.n for r in grand) == 7 and sum(r.n == 7 for r in grand) >= 3
    assert all(int(r.parent, 16) >> 55 == 4 and int(r.grand, 16) >> 55 == 3 for r in df.collect())
    top = inside.select(globe_parent(globe_cell(F.col("lat"), F.col("lon"), 0)).alias("p")).first()
    assert top.p is None


def test_neighbours(spark):
    res = 7
    found = points(spark, 300, 3).withColumn("cell", globe_cell(F.col("lat"), F.col("lon"), res))
    rows = found.select("cell", globe_center(F.col("cell")).alias("c"), globe_neighbours(F.col("cell")).alias("n")).collect()
    assert sum(len(r.n) == 6 for r in rows) > 290 and all(r.cell not in r.n and len(r.n) >= 3 for r in rows)
    pairs = spark.createDataFrame([(r.cell, n) for r in rows for n in r.n], "cell string, n string")
    far = pairs.select("cell", "n", globe_center(F.col("cell")).alias("a"), globe_center(F.col("n")).alias("b"), globe_neighbours(F.col("n")).alias("back")).collect()
    step = abs(bases()[res])
    mutual = 0
    for r in far:
        assert angle(sphere(r.a.lat, r.a.lon), sphere(r.b.lat, r.b.lon)) < 1.8 * step
        mutual += r.cell in r.back
    assert mutual > 0.97 * len(far)


def test_unknown_positions(spark):
    kinds = "lat double, lon double"
    rows = [(None, 1.0), (1.0, None), (0.0, 1.0), (1.0, 0.0), (91.0, 1.0), (1.0, 181.0), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, kinds).withColumn("cell", globe_cell(F.col("lat"), F.col("lon")))
    out = df.select("cell", globe_parent(F.col("cell")), globe_center(F.col("cell")), globe_neighbours(F.col("cell"))).collect()
    assert all(x is None for r in out for x in r)
    with pytest.raises(ValueError):
        globe_cell(F.col("lat"), F.col("lon"), 16)
    poles = spark.createDataFrame([(90.0, 5.0), (-90.0, 5.0)], kinds)
    assert all(r.c for r in poles.select(globe_cell(F.col("lat"), F.col("lon")).alias("c")).collect())
