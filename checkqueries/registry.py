"""Check queries: a Spark callable and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bioobs.functions.rings import point

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def num(value: float) -> str:
    """A double literal in SQL."""
    text = f"{value:.17g}"
    return text if "e" in text else text + "e0"


# positions derived from an order key, the same in both engines
LON_SQL = "(-139 + (o_orderkey * 7919 % 25000)::DOUBLE / 1000)"
LAT_SQL = "(48 + (o_orderkey * 104729 % 12000)::DOUBLE / 1000)"


def lon() -> Column:
    return F.lit(-139) + (F.col("o_orderkey") * 7919 % 25000).cast("double") / 1000


def lat() -> Column:
    return F.lit(48) + (F.col("o_orderkey") * 104729 % 12000).cast("double") / 1000


# a six-cornered, non-convex polygon around a centre derived from a nation key
CENTRE_LON_SQL = "(-137 + (n_nationkey * 7 % 25)::DOUBLE * 0.9e0)"
CENTRE_LAT_SQL = "(49.5e0 + (n_nationkey * 11 % 25)::DOUBLE * 0.38e0)"
OFFSETS = [(-0.8, -0.6), (0.9, -0.7), (0.5, 0.1), (1.1, 0.8), (-0.2, 0.4), (-1.0, 0.7)]
CORNERS_SQL = ", ".join(f"({i}, {num(a)}, {num(b)})" for i, (a, b) in enumerate(OFFSETS))


def centre() -> tuple[Column, Column]:
    return (
        F.lit(-137) + (F.col("n_nationkey") * 7 % 25).cast("double") * 0.9,
        F.lit(49.5) + (F.col("n_nationkey") * 11 % 25).cast("double") * 0.38,
    )


def nation_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """Polygons in degrees: ``polygon_id, geometry_type, rings, srid``."""
    cx, cy = centre()
    ring = F.array(*[point(cx + a, cy + b) for a, b in OFFSETS])
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("polygon_id"),
        F.lit("POLYGON").alias("geometry_type"),
        F.array(ring).alias("rings"),
        F.lit(4326).alias("srid"),
    )
