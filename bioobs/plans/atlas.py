"""Queries on an atlas of harmonised observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bioobs.functions.rings import box_ring, point_wkt, polygon_wkt
from bioobs.functions.values import as_numeric
from bioobs.operators.shape import unnest_struct


def dataset_counts(atlas: DataFrame, by: str = "dataset_name") -> DataFrame:
    """Observations per data set, largest first."""
    return atlas.groupBy(by).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), by)


def taxon_points(atlas: DataFrame, name: str) -> DataFrame:
    """Observations of one taxon, positions as numbers and as text geometry."""
    x, y = as_numeric("longitude"), as_numeric("latitude")
    found = atlas.where(F.col("valid_scientific_name") == name)
    return found.withColumns({"x": x, "y": y}).withColumns(
        {"geom": point_wkt("x", "y"), "srid": F.lit(4326)}
    )


def box_polygons(atlas: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """Polygons of the records that carry a bounding box."""
    boxes = atlas.where(F.col("geom_bbox").isNotNull())
    if limit is not None:
        boxes = boxes.orderBy(order).limit(limit)
    flat = unnest_struct(boxes, "geom_bbox")
    rings = F.array(box_ring(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]))
    return flat.withColumn("rings", rings).withColumns(
        {
            "geometry_type": F.lit("POLYGON"),
            "srid": F.lit(4326),
            "geom": polygon_wkt("rings"),
        }
    )
