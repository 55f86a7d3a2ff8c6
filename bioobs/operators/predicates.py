"""A small predicate language that compiles to one Spark column.

Comparisons reach the parquet reader as pushed filters. A region adds its
bounding box as plain comparisons, which are pushed too, before the exact test.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bioobs.functions.rings import inside_edges
from bioobs.operators.shape import named


class Predicate:
    def column(self, names: dict[str, str]) -> Column:
        raise NotImplementedError

    def rows(self) -> list[tuple]:
        """The predicate as ``(type, key, value, geometry)`` rows."""
        raise NotImplementedError

    def to_column(self, **names: str) -> Column:
        """``names`` maps predicate keys to table columns where they differ."""
        return self.column(names)


def _target(key: str, names: dict[str, str]) -> Column:
    return named(names.get(key, key.lower()))


@dataclass(frozen=True)
class Equals(Predicate):
    key: str
    value: object

    def column(self, names):
        return _target(self.key, names) == F.lit(self.value)

    def rows(self):
        text = str(self.value).lower() if isinstance(self.value, bool) else str(self.value)
        return [("equals", self.key, text, None)]


@dataclass(frozen=True)
class In(Predicate):
    key: str
    values: tuple

    def column(self, names):
        return _target(self.key, names).isin(*self.values)

    def rows(self):
        return [("in", self.key, str(v), None) for v in self.values]


@dataclass(frozen=True)
class Within(Predicate):
    """Inside a polygon given as WKT, its boundary included.

    Meant for outlines of modest size, such as a convex hull; a detailed
    boundary belongs in a table and in ``points_in_polygons``.
    """

    wkt: str

    def rings(self) -> list[list[tuple[float, float]]]:
        parts = re.findall(r"\(([^()]+)\)", self.wkt)
        return [[tuple(map(float, v.split()[:2])) for v in part.split(",")] for part in parts]

    def column(self, names):
        x, y = _target("longitude", names), _target("latitude", names)
        corners = [v for ring in self.rings() for v in ring]
        xs, ys = [v[0] for v in corners], [v[1] for v in corners]
        box = x.between(min(xs), max(xs)) & y.between(min(ys), max(ys))
        sides = []
        for ring in self.rings():
            loop = ring if ring[0] == ring[-1] else ring + ring[:1]
            for (x1, y1), (x2, y2) in zip(loop, loop[1:]):
                ends = {"x1": x1, "y1": y1, "x2": x2, "y2": y2}
                sides.append(F.struct(*[F.lit(v).alias(k) for k, v in ends.items()]))
        return box & inside_edges(x, y, F.array(*sides))

    def rows(self):
        return [("within", None, None, self.wkt)]


@dataclass(frozen=True)
class Not(Predicate):
    inner: Predicate

    def column(self, names):
        return ~self.inner.column(names)

    def rows(self):
        return [("not " + t, k, v, g) for t, k, v, g in self.inner.rows()]


@dataclass(frozen=True, init=False)
class And(Predicate):
    parts: tuple[Predicate, ...]

    def __init__(self, *parts: Predicate):
        object.__setattr__(self, "parts", parts)

    def column(self, names):
        return reduce(lambda a, b: a & b, [p.column(names) for p in self.parts])

    def rows(self):
        return [r for p in self.parts for r in p.rows()]


# --- fixed values: the quality filters every request starts from --------------
DEFAULT_QUALITY = And(
    Equals("HAS_GEOSPATIAL_ISSUE", False),
    Equals("HAS_COORDINATE", True),
    Equals("OCCURRENCE_STATUS", "PRESENT"),
    Not(In("BASIS_OF_RECORD", ("FOSSIL_SPECIMEN", "LIVING_SPECIMEN"))),
)

PREDICATE_ROW = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("type", "key", "value", "geometry")]
)


def predicate_table(spark: SparkSession, predicate: Predicate) -> DataFrame:
    return spark.createDataFrame(predicate.rows(), PREDICATE_ROW)
