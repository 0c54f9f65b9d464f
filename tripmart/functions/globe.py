"""A hexagonal grid of the whole globe as plain column expressions.

The sphere is divided among the 20 faces of an icosahedron, each of which is flattened around its
centre by the equal-area azimuthal projection and tiled with hexagons. So cells of one resolution
have one area at every latitude, except where a face's edge cuts them. A finer resolution has a
seventh of the area; its centres include those of the coarser one, which makes a hierarchy. Ids have
15 hexadecimal digits and are not indexes of any published grid.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

FINEST = 15
# Cells of resolution 0 on the whole sphere; each step multiplies them by seven.
COARSEST_CELLS = 122

# An id: resolution, face, and both axial coordinates with an offset.
AXIS_BITS, FACE_BITS = 25, 5
AXIS_OFFSET = 1 << (AXIS_BITS - 1)

GOLDEN = (1 + math.sqrt(5)) / 2

Vector = tuple[float, float, float]


def _cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def _unit(a: Vector) -> Vector:
    size = math.sqrt(sum(x * x for x in a))
    return tuple(x / size for x in a)


def faces() -> list[tuple[Vector, Vector, Vector]]:
    """Centre, east and north of each face: the centres are the corners of a dodecahedron."""
    corners = [tuple(map(float, s)) for s in itertools.product((-1, 1), repeat=3)]
    for i, j in itertools.product((-1, 1), repeat=2):
        short, long = i / GOLDEN, j * GOLDEN
        corners += [(0.0, short, long), (short, long, 0.0), (long, 0.0, short)]
    found = []
    for corner in sorted(corners):
        centre = _unit(corner)
        east = _unit(_cross((0.0, 0.0, 1.0), centre))
        found.append((centre, east, _cross(centre, east)))
    return found


def bases() -> list[complex]:
    """The step from a cell to its next, as a complex number, for each resolution.

    A coarser step is a finer one times a number of norm 7 over the hexagonal integers, by turns
    to the left and to the right, so resolutions two apart are parallel.
    """
    omega = complex(-0.5, math.sqrt(3) / 2)
    area = 4 * math.pi / COARSEST_CELLS
    step = complex(math.sqrt(2 * area / math.sqrt(3)), 0.0)
    found = [step]
    for res in range(1, FINEST + 1):
        step /= 3 + omega if res % 2 else 3 + omega.conjugate()
        found.append(step)
    return found


def _list(values: list[float]) -> Column:
    return F.array(*map(F.lit, values))


def _at(values: list[float], index: Column) -> Column:
    return F.get(_list(values), index)


def _sum(*terms: Column) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _rounded(a: Column, b: Column) -> tuple[Column, Column]:
    """The hexagon (axial coordinates) around a point given by them as fractions."""
    c = -a - b
    ra, rb, rc = (F.floor(v + F.lit(0.5)) for v in (a, b, c))
    da, db, dc = (F.abs(r - v) for r, v in ((ra, a), (rb, b), (rc, c)))
    q = F.when((da > db) & (da > dc), -rb - rc).otherwise(ra)
    r = F.when((da > db) & (da > dc), rb).when(db > dc, -ra - rc).otherwise(rb)
    return q, r


def _id(res: Column, face: Column, q: Column, r: Column) -> Column:
    packed = F.shiftleft(res.cast("long"), FACE_BITS + 2 * AXIS_BITS)
    packed = packed + F.shiftleft(face.cast("long"), 2 * AXIS_BITS)
    packed = packed + F.shiftleft(q + AXIS_OFFSET, AXIS_BITS) + (r + AXIS_OFFSET)
    return F.lpad(F.lower(F.hex(packed)), 15, "0")


def _cell_of(x: Column, y: Column, z: Column, res: Column) -> Column:
    """Cell id of a point on the unit sphere. The point goes through a lambda, so it is worked out once."""
    all_faces = faces()

    def on_face(p: Column) -> Column:
        px, py, pz = p["x"], p["y"], p["z"]
        dots = F.array(*[px * c[0] + py * c[1] + pz * c[2] for c, _, _ in all_faces])

        def flat(d: Column) -> Column:
            face = (F.array_position(d, F.array_max(d)) - 1).cast("int")
            scale = F.sqrt(F.lit(2.0) / (F.lit(1.0) + F.array_max(d)))
            axes = []
            for k in (1, 2):
                axes.append(
                    scale * _sum(*(v * _at([f[k][i] for f in all_faces], face) for i, v in enumerate((px, py, pz))))
                )
            return F.struct(face.alias("face"), axes[0].alias("u"), axes[1].alias("v"))

        def named(f: Column) -> Column:
            inverse = [1 / b for b in bases()]
            real, imag = _at([i.real for i in inverse], res), _at([i.imag for i in inverse], res)
            across = f["u"] * real - f["v"] * imag
            up = f["u"] * imag + f["v"] * real
            a = across + up / F.lit(math.sqrt(3))
            b = up * F.lit(-2 / math.sqrt(3))
            return F.struct(f["face"].alias("face"), a.alias("a"), b.alias("b"))

        def packed(w: Column) -> Column:
            q, r = _rounded(w["a"], w["b"])
            return _id(res, w["face"], q, r)

        return _once(_once(_once(dots, flat), named), packed)

    return _once(F.struct(x.alias("x"), y.alias("y"), z.alias("z")), on_face)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it occurs."""
    return F.get(F.transform(F.array(value), use), 0)


def globe_cell(lat: Column, lon: Column, res: int = 9) -> Column:
    """Cell id of a point; NULL by the rules of `hex_cell` (unknown, off the globe, or zero)."""
    if not 0 <= res <= FINEST:
        raise ValueError(f"resolution must lie in 0..{FINEST}, not {res}")
    lat, lon = lat.try_cast("double"), lon.try_cast("double")
    on_globe = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0) & (lat != 0.0) & (lon != 0.0)
    phi, lam = F.radians(lat), F.radians(lon)
    x, y, z = F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)
    return F.when(on_globe, _cell_of(x, y, z, F.lit(res)))


def _parts(cell: Column) -> Column:
    packed = F.conv(cell, 16, 10).cast("long")
    axis = F.lit((1 << AXIS_BITS) - 1)
    return F.struct(
        F.shiftright(packed, FACE_BITS + 2 * AXIS_BITS).cast("int").alias("res"),
        F.shiftright(packed, 2 * AXIS_BITS).bitwiseAND(F.lit((1 << FACE_BITS) - 1)).cast("int").alias("face"),
        (F.shiftright(packed, AXIS_BITS).bitwiseAND(axis) - AXIS_OFFSET).alias("q"),
        (packed.bitwiseAND(axis) - AXIS_OFFSET).alias("r"),
    )


def globe_parent(cell: Column) -> Column:
    """The cell of the next coarser resolution that this one belongs to; NULL at the coarsest.

    Every cell has seven children: that around its own centre and the six around it.
    """

    def up(p: Column) -> Column:
        # divide by the step's number: times its conjugate, by seven
        a, b = p["q"].cast("double"), -p["r"].cast("double")
        odd = p["res"] % 2 == 1
        # (a + b w)(conj(3 + w)) = (a + b w)(2 - w), and (a + b w)(3 + w) for the other turn
        real = F.when(odd, 2 * a + b).otherwise(3 * a - b) / 7
        other = F.when(odd, 3 * b - a).otherwise(a + 2 * b) / 7
        q, r = _rounded(real, -other)
        return F.when(p["res"] > 0, _id(p["res"] - 1, p["face"], q, r))

    return F.when(cell.isNotNull(), _once(_parts(cell), up))


def _point(face: Column, res: Column, q: Column, r: Column) -> Column:
    """The point on the unit sphere at axial coordinates of a face."""
    all_faces = faces()
    a, b = q.cast("double"), -r.cast("double")
    across, up = a - b / 2, b * F.lit(math.sqrt(3) / 2)
    steps = bases()
    real, imag = _at([s.real for s in steps], res), _at([s.imag for s in steps], res)

    def lifted(flat: Column) -> Column:
        u, v = flat["u"], flat["v"]
        d = F.lit(1.0) - (u * u + v * v) / 2
        shrink = F.sqrt(F.lit(1.0) - (u * u + v * v) / 4)
        axes = [
            d * _at([f[0][i] for f in all_faces], face)
            + shrink * (u * _at([f[1][i] for f in all_faces], face) + v * _at([f[2][i] for f in all_faces], face))
            for i in range(3)
        ]
        return F.struct(axes[0].alias("x"), axes[1].alias("y"), axes[2].alias("z"))

    flat = F.struct((across * real - up * imag).alias("u"), (across * imag + up * real).alias("v"))
    return _once(flat, lifted)


def globe_center(cell: Column) -> Column:
    """Centre of a cell as a struct of ``lat`` and ``lon``, in degrees."""

    def centre(p: Column) -> Column:
        def degrees(v: Column) -> Column:
            return F.struct(
                F.degrees(F.asin(F.greatest(F.least(v["z"], F.lit(1.0)), F.lit(-1.0)))).alias("lat"),
                F.degrees(F.atan2(v["y"], v["x"])).alias("lon"),
            )

        return _once(_point(p["face"], p["res"], p["q"], p["r"]), degrees)

    return F.when(cell.isNotNull(), _once(_parts(cell), centre))


def globe_neighbours(cell: Column) -> Column:
    """Ids of the cells one step away in each of the six directions, without the cell itself.

    A step that leaves the face ends in the cell of the other face that lies there, so beside an
    edge two steps may end in one cell, and being a neighbour need not be mutual there.
    """
    steps = [(1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)]

    def around(p: Column) -> Column:
        def there(step: tuple[int, int]) -> Column:
            point = _point(p["face"], p["res"], p["q"] + step[0], p["r"] + step[1])
            return _once(point, lambda v: _cell_of(v["x"], v["y"], v["z"], p["res"]))

        return F.array(*map(there, steps))

    found = F.array_distinct(_once(_parts(cell), around))
    return F.when(cell.isNotNull(), F.array_sort(F.array_remove(found, cell)))
