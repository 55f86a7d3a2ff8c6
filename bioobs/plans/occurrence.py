"""Occurrence records: fill ranks, clip to a boundary, write by taxon."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bioobs.functions.projection import reproject
from bioobs.functions.rings import reproject_rings
from bioobs.functions.values import coalesce_each
from bioobs.operators.spatial import (
    BROADCAST_BYTES,
    convex_hull,
    degrees_box,
    edges,
    expecting_srid,
    fit_grid,
    hull_ring,
    points_in_polygons,
    with_srid,
)
from bioobs.schemas import RANKS
from bioobs.sources.sinks import write_partitioned

PARTITION_RANKS = ["kingdom", "phylum", "class"]


def with_known_ranks(occurrence: DataFrame, ranks=RANKS, value: str = "unknown") -> DataFrame:
    return occurrence.withColumns(coalesce_each(ranks, value))


def projected_points(
    df: DataFrame, srid: int, lon: str = "decimallongitude", lat: str = "decimallatitude"
) -> DataFrame:
    """Replace degrees by ``x, y`` in a projected system."""
    x, y = reproject(lon, lat, 4326, srid)
    return with_srid(df.withColumns({"x": x, "y": y}).drop(lon, lat), srid)


def clip_to_boundary(
    occurrence: DataFrame,
    boundary: DataFrame,
    srid: int = 3005,
    lon: str = "decimallongitude",
    lat: str = "decimallatitude",
    ranks=RANKS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Records inside the boundary (its edge included), in its coordinate system.

    ``boundary`` is already in ``srid``. A box in degrees that surely contains it
    filters the raw coordinates first, which the parquet reader can use; the
    exact test then runs in the boundary's own system.
    """
    boundary = expecting_srid(boundary, srid)
    grid = fit_grid(edges(boundary), broadcast_bytes)
    if grid is None:
        empty = projected_points(with_known_ranks(occurrence, ranks), srid, lon, lat)
        return empty.where(F.lit(False))
    x0, y0, x1, y1 = degrees_box(grid, srid)
    near = occurrence.where(F.col(lon).between(x0, x1) & F.col(lat).between(y0, y1))
    points = projected_points(with_known_ranks(near, ranks), srid, lon, lat)
    return points_in_polygons(points, boundary, grid=grid)


def write_clipped(clipped: DataFrame, path: str, by=PARTITION_RANKS) -> None:
    write_partitioned(clipped, path, by)


def request_region(boundary: DataFrame, source: int = 3005, per_polygon: bool = False) -> DataFrame:
    """Convex hull of the whole boundary in degrees, as rings: ``pid, rings, srid``.

    ``per_polygon`` gives one hull for each polygon; otherwise ``pid`` is NULL.
    """
    kind = boundary.schema["polygon_id"].dataType
    group = F.col("pid") if per_polygon else F.lit(None).cast(kind).alias("pid")
    corners = edges(boundary).select(group, F.col("x1").alias("x"), F.col("y1").alias("y"))
    hull = hull_ring(convex_hull(corners, "pid"), "pid")
    return hull.withColumn("rings", reproject_rings("rings", source, 4326)).withColumn("srid", F.lit(4326))
