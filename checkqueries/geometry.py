"""Points, projections, polygon measures, hulls and point in polygon."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from bioobs.functions import projection as P
from bioobs.functions.rings import (
    area_m2,
    box_ring,
    centroid,
    circle_radius,
    closed,
    point_wkt,
    polygon_wkt,
    reproject_rings,
)
from bioobs.operators.spatial import convex_hull, tag_points
from bioobs.plans.atlas import box_polygons, taxon_points
from bioobs.session import shared_folder
from bioobs.sources.readers import read_kml
from checkqueries.registry import (
    CENTRE_LAT_SQL,
    CENTRE_LON_SQL,
    CORNERS_SQL,
    LAT_SQL,
    LON_SQL,
    centre,
    check,
    lat,
    lon,
    nation_polygons,
    num,
    table,
)

# ---- the projections once more, from published definitions and without the package's constants

# fixed values: GRS80 (EPSG:7019); EPSG:3005; the series of Deakin, Hunter and Karney,
# "The Gauss-Krueger projection" (2010), for GRS80; EPSG:32610
SEMI_MAJOR, INVERSE_FLATTENING = "6378137e0", "298.257222101e0"
ORIGIN_LAT, ORIGIN_LON, PARALLEL_1, PARALLEL_2, FALSE_EASTING = "45e0", "-126e0", "50e0", "58.5e0", "1000000e0"
RECTIFYING_RADIUS = "6367449.145771e0"
FORWARD = ["8.377318247344e-4", "7.608527788826e-7", "1.197638019173e-9", "2.443376242510e-12"]
BACKWARD = ["8.377321681641e-4", "5.905869626083e-8", "1.673488904988e-10", "2.167737805597e-13"]
ZONE_SCALE, ZONE_MERIDIAN, ZONE_EASTING = "0.9996e0", "-123e0", "500000e0"

E2 = f"((2 - 1 / {INVERSE_FLATTENING}) / {INVERSE_FLATTENING})"
ECC = f"sqrt({E2})"


def _authalic_sql(lat_sql: str) -> str:
    s = f"sin(radians({lat_sql}))"
    return f"((1 - {E2}) * ({s} / (1 - {E2} * {s} * {s}) - ln((1 - {ECC} * {s}) / (1 + {ECC} * {s})) / (2 * {ECC})))"


def _parallel2_sql(lat_sql: str) -> str:
    """The squared radius of a parallel, in semi-major axes."""
    return f"(pow(cos(radians({lat_sql})), 2) / (1 - {E2} * pow(sin(radians({lat_sql})), 2)))"


def albers_sql(lon_sql: str, lat_sql: str) -> tuple[str, str]:
    """x and y of EPSG:3005: Snyder, equations 14-1 to 14-16."""
    m1, m2 = _parallel2_sql(PARALLEL_1), _parallel2_sql(PARALLEL_2)
    q1, q2 = _authalic_sql(PARALLEL_1), _authalic_sql(PARALLEL_2)
    n = f"(({m1} - {m2}) / ({q2} - {q1}))"
    rho = lambda q: f"({SEMI_MAJOR} * sqrt({m1} + {n} * ({q1} - {q})) / {n})"
    here, origin = rho(_authalic_sql(lat_sql)), rho(_authalic_sql(ORIGIN_LAT))
    theta = f"({n} * radians({lon_sql} - {ORIGIN_LON}))"
    return f"({FALSE_EASTING} + {here} * sin({theta}))", f"({origin} - {here} * cos({theta}))"


def utm_sql(lon_sql: str, lat_sql: str) -> tuple[str, str]:
    """x and y of EPSG:32610."""
    s = f"sin(radians({lat_sql}))"
    t = f"sinh(atanh({s}) - {ECC} * atanh({ECC} * {s}))"
    lam = f"radians({lon_sql} - {ZONE_MERIDIAN})"
    xi = f"atan2({t}, cos({lam}))"
    eta = f"asinh(sin({lam}) / sqrt({t} * {t} + cos({lam}) * cos({lam})))"
    north, east = xi, eta
    for j, a in enumerate(FORWARD, start=1):
        north += f" + {a} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})"
        east += f" + {a} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})"
    k = f"({ZONE_SCALE} * {RECTIFYING_RADIUS})"
    return f"({ZONE_EASTING} + {k} * ({east}))", f"({k} * ({north}))"


def geographic_sql(chi_sql: str) -> str:
    """Latitude in degrees from conformal latitude, by repeated substitution."""
    target, s = f"asinh(tan({chi_sql}))", f"sin({chi_sql})"
    for _ in range(9):
        s = f"tanh({target} + {ECC} * atanh({ECC} * {s}))"
    return f"degrees(asin({s}))"


AX, AY = albers_sql("lon", "lat")
UX, UY = utm_sql("ulon", "lat")
POINTS_SQL = f"SELECT o_orderkey, {LON_SQL} AS lon, {LAT_SQL} AS lat FROM orders"
ULON_SQL = "(-126 + (o_orderkey * 7919 % 6000)::DOUBLE / 1000)"


def positions(spark, d):
    return table(spark, d, "orders").select("o_orderkey", lon().alias("lon"), lat().alias("lat"))


@check("q_points", f"""
SELECT o_orderkey, lon AS x, lat AS y, 4326 AS srid, 'POINT (' || lon::VARCHAR || ' ' || lat::VARCHAR || ')' AS geom
FROM ({POINTS_SQL})
""")
def q_points(spark, d):
    rows = positions(spark, d).withColumnsRenamed({"lon": "x", "lat": "y"})
    return rows.withColumns({"srid": F.lit(4326), "geom": point_wkt("x", "y")})


@check("q_taxon_points", f"""
SELECT o_orderkey, valid_scientific_name, longitude, latitude, try_cast(longitude AS DOUBLE) AS x, try_cast(latitude AS DOUBLE) AS y,
       'POINT (' || try_cast(longitude AS DOUBLE)::VARCHAR || ' ' || try_cast(latitude AS DOUBLE)::VARCHAR || ')' AS geom, 4326 AS srid
FROM (SELECT o_orderkey, o_orderpriority AS valid_scientific_name,
             CASE WHEN o_orderkey % 8 = 0 THEN 'unknown' ELSE lon::VARCHAR END AS longitude, lat::VARCHAR AS latitude
      FROM ({POINTS_SQL}) JOIN orders USING (o_orderkey))
WHERE valid_scientific_name = '2-HIGH'
""")
def q_taxon_points(spark, d):
    atlas = table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("valid_scientific_name"),
        F.when(F.col("o_orderkey") % 8 == 0, "unknown").otherwise(lon().cast("string")).alias("longitude"),
        lat().cast("string").alias("latitude"),
    )
    return taxon_points(atlas, "2-HIGH")


@check("q_albers", f"""
SELECT o_orderkey, round({AX}, 3) AS x, round({AY}, 3) AS y, round(lon, 9) AS lon_back, round(lat, 9) AS lat_back
FROM ({POINTS_SQL})
""")
def q_albers(spark, d):
    x, y = P.reproject("lon", "lat", 4326, 3005)
    there = positions(spark, d).select("o_orderkey", x.alias("x"), y.alias("y"))
    back = P.reproject("x", "y", 3005, 4326)
    return there.select(
        "o_orderkey",
        F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"),
        F.round(back[0], 9).alias("lon_back"),
        F.round(back[1], 9).alias("lat_back"),
    )


@check("q_utm_inverse", f"""
SELECT o_orderkey, round({UX}, 3) AS x, round({UY}, 3) AS y, round(ulon, 9) AS lon_back, round(lat, 9) AS lat_back
FROM (SELECT o_orderkey, {ULON_SQL} AS ulon, {LAT_SQL} AS lat FROM orders)
""")
def q_utm_inverse(spark, d):
    ulon = F.lit(-126) + (F.col("o_orderkey") * 7919 % 6000).cast("double") / 1000
    rows = table(spark, d, "orders").select("o_orderkey", ulon.alias("lon"), lat().alias("lat"))
    x, y = P.reproject("lon", "lat", 4326, 32610)
    there = rows.select("o_orderkey", x.alias("x"), y.alias("y"))
    back = P.reproject("x", "y", 32610, 4326)
    return there.select(
        "o_orderkey",
        F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"),
        F.round(back[0], 9).alias("lon_back"),
        F.round(back[1], 9).alias("lat_back"),
    )


@check("q_bbox_polygon", f"""
SELECT n_nationkey, xmin, ymin, xmax, ymax,
       'POLYGON ((' || xmin || ' ' || ymin || ', ' || xmax || ' ' || ymin || ', ' || xmax || ' ' || ymax || ', '
       || xmin || ' ' || ymax || ', ' || xmin || ' ' || ymin || '))' AS geom
FROM (SELECT n_nationkey, {CENTRE_LON_SQL} - 0.5e0 AS xmin, {CENTRE_LAT_SQL} - 0.25e0 AS ymin,
             {CENTRE_LON_SQL} + 0.5e0 AS xmax, {CENTRE_LAT_SQL} + 0.25e0 AS ymax,
             CASE WHEN n_nationkey % 5 <> 0 THEN 'box' END AS geom_bbox FROM nation)
WHERE geom_bbox IS NOT NULL
""")
def q_bbox_polygon(spark, d):
    cx, cy = centre()
    box = F.struct(
        (cx - 0.5).alias("xmin"), (cy - 0.25).alias("ymin"), (cx + 0.5).alias("xmax"), (cy + 0.25).alias("ymax")
    )
    atlas = table(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 5 != 0, box).alias("geom_bbox"))
    return box_polygons(atlas, "n_nationkey").drop("rings", "geometry_type", "srid")


VERTICES_SQL = f"""
SELECT n_nationkey, i, {CENTRE_LON_SQL} + a AS lon, {CENTRE_LAT_SQL} + b AS lat
FROM nation, (VALUES {CORNERS_SQL}) t(i, a, b)
"""


@check("q_polygon_measures", f"""
WITH v AS (SELECT n_nationkey, i, lon, lat, {AX} AS x, {AY} AS y FROM ({VERTICES_SQL})),
o AS (SELECT n_nationkey, lon AS lon0, lat AS lat0, x AS x0, y AS y0 FROM v WHERE i = 0),
e AS (SELECT a.n_nationkey, lon0, lat0, (a.x - x0) * (b.y - y0) - (b.x - x0) * (a.y - y0) AS w,
             (a.lon - lon0) * (b.lat - lat0) - (b.lon - lon0) * (a.lat - lat0) AS c,
             a.lon + b.lon - 2 * lon0 AS sx, a.lat + b.lat - 2 * lat0 AS sy
      FROM v a JOIN v b ON a.n_nationkey = b.n_nationkey AND b.i = (a.i + 1) % 6 JOIN o ON o.n_nationkey = a.n_nationkey),
g AS (SELECT n_nationkey, sum(w) / 2 AS area, any_value(lon0) + sum(sx * c) / (3 * sum(c)) AS cx,
             any_value(lat0) + sum(sy * c) / (3 * sum(c)) AS cy FROM e GROUP BY n_nationkey)
SELECT n_nationkey, round(area, 0) AS area, round(cx, 9) AS lon, round(cy, 9) AS lat, round(sqrt(area / pi()), 3) AS radius FROM g
""")
def q_polygon_measures(spark, d):
    rows = nation_polygons(spark, d).withColumns({"centre": centroid("rings"), "area": area_m2("rings")})
    return rows.select(
        F.col("polygon_id").alias("n_nationkey"),
        F.round("area", 0).alias("area"),
        F.round("centre.x", 9).alias("lon"),
        F.round("centre.y", 9).alias("lat"),
        F.round(circle_radius("area"), 3).alias("radius"),
    )


@check("q_boundary_reproject", f"""
SELECT n_nationkey, i, round({AX}, 3) AS x, round({AY}, 3) AS y, round(lon, 9) AS lon, round(lat, 9) AS lat FROM ({VERTICES_SQL})
""")
def q_boundary_reproject(spark, d):
    there = nation_polygons(spark, d).withColumn("there", reproject_rings("rings", 4326, 3005))
    back = there.withColumn("back", reproject_rings("there", 3005, 4326))
    pairs = F.arrays_zip(F.col("there")[0].alias("t"), F.col("back")[0].alias("b"))
    rows = back.select(F.col("polygon_id").alias("n_nationkey"), F.posexplode(pairs).alias("i", "p"))
    return rows.select(
        "n_nationkey",
        "i",
        F.round("p.t.x", 3).alias("x"),
        F.round("p.t.y", 3).alias("y"),
        F.round("p.b.x", 9).alias("lon"),
        F.round("p.b.y", 9).alias("lat"),
    )


@check("q_polygon_wkt", f"""
SELECT n_nationkey, 'POLYGON ((' || string_agg(lon || ' ' || lat, ', ' ORDER BY i) || ', ' || min(CASE WHEN i = 0 THEN lon || ' ' || lat END) || '))' AS wkt
FROM ({VERTICES_SQL}) GROUP BY n_nationkey
""")
def q_polygon_wkt(spark, d):
    rows = nation_polygons(spark, d)
    return rows.select(
        F.col("polygon_id").alias("n_nationkey"), polygon_wkt(F.transform("rings", closed)).alias("wkt")
    )


# a corner leaves an angle of more than half a turn free of other points
@check("q_convex_hull", f"""
WITH p AS (SELECT DISTINCT c_nationkey AS g, (o_orderkey * 7919 % 25000)::DOUBLE AS x, (o_orderkey * 104729 % 12000)::DOUBLE AS y
           FROM orders JOIN customer ON o_custkey = c_custkey),
a AS (SELECT p.g, p.x, p.y, atan2(q.y - p.y, q.x - p.x) AS t FROM p JOIN p q ON p.g = q.g AND (p.x <> q.x OR p.y <> q.y)),
n AS (SELECT g, x, y, t, coalesce(lead(t) OVER w, min(t) OVER (PARTITION BY g, x, y) + {num(2 * math.pi)}) - t AS gap FROM a
      WINDOW w AS (PARTITION BY g, x, y ORDER BY t))
SELECT g, x, y FROM n GROUP BY g, x, y HAVING max(gap) > pi() + 1e-10
""")
def q_convex_hull(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    points = rows.select(
        F.col("c_nationkey").alias("g"),
        (F.col("o_orderkey") * 7919 % 25000).cast("double").alias("x"),
        (F.col("o_orderkey") * 104729 % 12000).cast("double").alias("y"),
    )
    return convex_hull(points, "g").select("g", "x", "y")


@check("q_tag_points", f"""
SELECT o_orderkey, n_nationkey FROM ({POINTS_SQL})
JOIN (SELECT n_nationkey, (-139 + n_nationkey)::DOUBLE AS x0, (48 + n_nationkey % 9)::DOUBLE AS y0 FROM nation)
ON lon BETWEEN x0 AND x0 + 2.5e0 AND lat BETWEEN y0 AND y0 + 2
   AND NOT (lon > x0 + 1 AND lon < x0 + 2 AND lat > y0 + 0.5e0 AND lat < y0 + 1.5e0)
""")
def q_tag_points(spark, d):
    x0 = (F.lit(-139) + F.col("n_nationkey")).cast("double")
    y0 = (F.lit(48) + F.col("n_nationkey") % 9).cast("double")
    outer = box_ring(x0, y0, x0 + 2.5, y0 + 2)
    hole = F.reverse(box_ring(x0 + 1, y0 + 0.5, x0 + 2, y0 + 1.5))
    boxes = table(spark, d, "nation").select("n_nationkey", F.array(outer, hole).alias("rings"))
    return tag_points(positions(spark, d), boxes, "lon", "lat", "n_nationkey").select("o_orderkey", "n_nationkey")


@check("q_kml", f"""
SELECT 'site_' || n_nationkey AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'POINT' ELSE 'POLYGON' END AS geometry_type,
       round({CENTRE_LON_SQL} + CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE 0.25e0 END, 9) AS x,
       round({CENTRE_LAT_SQL} + CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE 0.25e0 END, 9) AS y, 4326 AS srid
FROM nation
""")
def q_kml(spark, d):
    cx, cy = centre()
    pair = lambda dx, dy: F.concat_ws(",", (cx + dx).cast("string"), (cy + dy).cast("string"), F.lit("0"))
    square = F.concat_ws(" ", *[pair(a, b) for a, b in [(0, 0), (0, 0.5), (0.5, 0.5), (0.5, 0), (0, 0)]])
    dot = F.concat(F.lit("<Point><coordinates>"), pair(0, 0), F.lit("</coordinates></Point>"))
    area = F.concat(
        F.lit("<Polygon><outerBoundaryIs><LinearRing><coordinates>"),
        square,
        F.lit("</coordinates></LinearRing></outerBoundaryIs></Polygon>"),
    )
    mark = F.concat(
        F.lit("<Placemark><name>site_"),
        F.col("n_nationkey").cast("string"),
        F.lit("</name>"),
        F.when(F.col("n_nationkey") % 3 == 0, dot).otherwise(area),
        F.lit("</Placemark>"),
    )
    path = shared_folder(spark, "kml")
    # one document per region, one file per document
    marks = table(spark, d, "nation").groupBy("n_regionkey").agg(F.string_agg(mark).alias("marks"))
    kml = F.concat(F.lit("<kml><Document>"), F.col("marks"), F.lit("</Document></kml>"))
    marks.select(kml.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    marks = read_kml(spark, path).withColumn("centre", centroid("rings"))
    return marks.select(
        "name", "geometry_type", F.round("centre.x", 9).alias("x"), F.round("centre.y", 9).alias("y"), "srid"
    )
