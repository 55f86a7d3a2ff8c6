"""Polygon arithmetic on ``array<array<struct<x,y>>>`` columns.

Outer rings run counter-clockwise and holes clockwise (``oriented`` makes it so),
so signed sums handle holes and several parts without extra bookkeeping.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bioobs.functions.projection import reproject
from bioobs.functions.text import ColumnOrName, _col


def point(x, y) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _once(value: Column, use) -> Column:
    """Apply ``use`` to a value that should be computed a single time."""
    return F.transform(F.array(value), use)[0]


def closed(ring: Column) -> Column:
    """The ring with its first vertex repeated at the end."""

    def close(r):
        same = F.element_at(r, 1) == F.element_at(r, -1)
        return F.when(same, r).otherwise(F.concat(r, F.slice(r, 1, 1)))

    return _once(ring, close)


def ring_edges(ring: Column) -> Column:
    """Array of ``{a, b}`` vertex pairs."""

    def pairs(loop):
        n = F.size(loop) - 1
        return F.arrays_zip(F.slice(loop, 1, n).alias("a"), F.slice(loop, 2, n).alias("b"))

    return _once(closed(ring), pairs)


def ring_moments(ring: Column) -> Column:
    """``{area, mx, my}``: twice the signed area and six times the signed moments.

    Sums are taken relative to the first vertex, which keeps the digits that
    large coordinates would cancel.
    """

    def measure(r):
        o = F.element_at(r, 1)

        def add(acc, e):
            ax, ay = e["a"]["x"] - o["x"], e["a"]["y"] - o["y"]
            bx, by = e["b"]["x"] - o["x"], e["b"]["y"] - o["y"]
            cross = ax * by - bx * ay
            return F.struct(
                (acc["area"] + cross).alias("area"),
                (acc["mx"] + (ax + bx) * cross).alias("mx"),
                (acc["my"] + (ay + by) * cross).alias("my"),
            )

        def shifted_back(rel):
            return F.struct(
                rel["area"].alias("area"),
                (rel["mx"] + 3 * o["x"] * rel["area"]).alias("mx"),
                (rel["my"] + 3 * o["y"] * rel["area"]).alias("my"),
            )

        zero = F.struct(*[F.lit(0.0).alias(n) for n in ("area", "mx", "my")])
        return F.aggregate(ring_edges(r), zero, add, shifted_back)

    return _once(ring, measure)


def oriented(ring: Column, hole: bool) -> Column:
    """Closed ring, counter-clockwise, or clockwise for a hole."""

    def turn(loop):
        area = ring_moments(loop)["area"]
        return F.when((area > 0) if hole else (area < 0), F.reverse(loop)).otherwise(loop)

    return _once(closed(ring), turn)


def polygon_moments(rings: ColumnOrName) -> Column:
    """``ring_moments`` summed over all rings."""

    def add(acc, ring):
        total = lambda m: F.struct(*[(acc[n] + m[n]).alias(n) for n in ("area", "mx", "my")])
        return _once(ring_moments(ring), total)

    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("area", "mx", "my")])
    return F.aggregate(_col(rings), zero, add)


def planar_area(rings: ColumnOrName) -> Column:
    return polygon_moments(rings)["area"] / 2


def centroid(rings: ColumnOrName) -> Column:
    """Area centroid as ``{x, y}``; a single vertex is its own centroid."""
    rings = _col(rings)

    def mean(m):
        weight = F.nullif(3 * m["area"], F.lit(0.0))
        return point(m["mx"] / weight, m["my"] / weight)

    return F.when(F.size(rings[0]) == 1, rings[0][0]).otherwise(_once(polygon_moments(rings), mean))


def reproject_rings(rings: ColumnOrName, source: int, target: int) -> Column:
    return F.transform(
        _col(rings),
        lambda ring: F.transform(ring, lambda v: point(*reproject(v["x"], v["y"], source, target))),
    )


def area_m2(rings: ColumnOrName, srid: int = 4326) -> Column:
    """Square metres, measured in the equal-area projection."""
    return planar_area(reproject_rings(rings, srid, 3005))


def circle_radius(area: ColumnOrName) -> Column:
    """Radius of the circle with this area."""
    return F.sqrt(_col(area) / F.pi())


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    corners = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return F.array(*[point(x, y) for x, y in corners])


def polygon_wkt(rings: ColumnOrName) -> Column:
    """``POLYGON ((x y, …), (…))``."""

    def one(ring):
        pairs = F.transform(
            ring, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))
        )
        return F.concat(F.lit("("), F.array_join(pairs, ", "), F.lit(")"))

    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(_col(rings), one), ", "), F.lit(")"))


def point_wkt(x: ColumnOrName, y: ColumnOrName) -> Column:
    return F.concat(
        F.lit("POINT ("), _col(x).cast("string"), F.lit(" "), _col(y).cast("string"), F.lit(")")
    )


def on_segment(px, py, x1, y1, x2, y2) -> Column:
    """The point lies exactly on the closed segment."""
    return (
        ((x2 - x1) * (py - y1) == (y2 - y1) * (px - x1))
        & px.between(F.least(x1, x2), F.greatest(x1, x2))
        & py.between(F.least(y1, y2), F.greatest(y1, y2))
    )


def crosses_right(px, py, x1, y1, x2, y2) -> Column:
    """The ray from the point towards +x crosses the segment (half-open in y)."""
    spans = (y1 > py) != (y2 > py)
    return spans & (px < x1 + (py - y1) * (x2 - x1) / F.nullif(y2 - y1, F.lit(0.0)))


def inside_edges(px: Column, py: Column, sides: Column) -> Column:
    """Even-odd test against an array of ``{x1, y1, x2, y2}``, the edge included."""
    parts = lambda test: lambda e: test(px, py, e["x1"], e["y1"], e["x2"], e["y2"])
    odd = F.size(F.filter(sides, parts(crosses_right))) % 2 == 1
    return odd | F.exists(sides, parts(on_segment))
