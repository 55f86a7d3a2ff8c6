"""Whole jobs on data derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bioobs.fixed_values import REQUEST_SOURCE, REQUEST_STATUS, REUSE_DAYS
from bioobs.functions.rings import box_ring, point, polygon_wkt, reproject_rings
from bioobs.operators.ordering import BLOCK, with_key_chunk
from bioobs.operators.predicates import DEFAULT_QUALITY, predicate_table
from bioobs.operators.shape import bind_rows
from bioobs.plans.download_requests import request_for, request_for_boundary, reusable_download
from bioobs.plans.occurrence import clip_to_boundary, request_region, write_clipped
from bioobs.plans.surveys import (
    long_census_observations,
    plot_census_observations,
    stream_survey_observations,
    wide_census_observations,
)
from bioobs.schemas import OBSERVATION_SCHEMA
from bioobs.session import shared_folder
from bioobs.sources.readers import scan_data_files
from bioobs.streaming.clip_stream import start_clip_stream
from checkqueries.geometry import AX, AY, BACKWARD, POINTS_SQL, RECTIFYING_RADIUS, VERTICES_SQL, ZONE_SCALE, geographic_sql
from checkqueries.registry import (
    CENTRE_LAT_SQL,
    CENTRE_LON_SQL,
    centre,
    check,
    lat,
    lon,
    nation_polygons,
    num,
    table,
)

# ------------------------------------------------------------ occurrence clip

TAXA = ["kingdom", "phylum", "class"]


def occurrence(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderstatus")).alias("kingdom"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("phylum"),
        F.when(F.col("o_orderkey") % 10 != 0, F.concat(F.lit("c"), F.col("o_orderkey") % 3)).alias("class"),
        lon().alias("decimallongitude"),
        lat().alias("decimallatitude"),
    )


def boundary(spark, d):
    """The nation polygons in the projected system."""
    return nation_polygons(spark, d).withColumns(
        {"rings": reproject_rings("rings", 4326, 3005), "srid": F.lit(3005)}
    )


CLIP_SQL = f"""
WITH v AS (SELECT n_nationkey, i, {AX} AS x, {AY} AS y FROM ({VERTICES_SQL})),
e AS (SELECT a.n_nationkey, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
      FROM v a JOIN v b ON a.n_nationkey = b.n_nationkey AND b.i = (a.i + 1) % 6),
p AS (SELECT o_orderkey, {AX} AS x, {AY} AS y FROM ({POINTS_SQL})),
hits AS (SELECT o_orderkey FROM p, e WHERE (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
         GROUP BY o_orderkey, n_nationkey HAVING count(*) % 2 = 1
         UNION SELECT o_orderkey FROM p, e WHERE (x2 - x1) * (y - y1) = (y2 - y1) * (x - x1)
           AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2))
SELECT o_orderkey,
       coalesce(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END, 'unknown') AS kingdom,
       coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END, 'unknown') AS phylum,
       coalesce(CASE WHEN o_orderkey % 10 <> 0 THEN 'c' || (o_orderkey % 3)::VARCHAR END, 'unknown') AS class,
       round(x, 3) AS x, round(y, 3) AS y, 3005 AS srid
FROM orders JOIN p USING (o_orderkey) WHERE o_orderkey IN (SELECT o_orderkey FROM hits)
"""


def _rounded(clipped):
    return clipped.select("o_orderkey", *TAXA, F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "srid")


@check("q_spatial_clip", CLIP_SQL)
def q_spatial_clip(spark, d):
    return _rounded(clip_to_boundary(occurrence(spark, d), boundary(spark, d), ranks=TAXA))


@check("q_spatial_clip_shuffled", CLIP_SQL)
def q_spatial_clip_shuffled(spark, d):
    """As if the boundary were too large to copy to every executor."""
    return _rounded(clip_to_boundary(occurrence(spark, d), boundary(spark, d), ranks=TAXA, broadcast_bytes=0))


@check("q_clip_hive", CLIP_SQL)
def q_clip_hive(spark, d):
    path = shared_folder(spark, "clip")
    write_clipped(clip_to_boundary(occurrence(spark, d), boundary(spark, d), ranks=TAXA), path)
    return _rounded(scan_data_files(spark, path))


@check("q_clip_stream", CLIP_SQL)
def q_clip_stream(spark, d):
    rows = occurrence(spark, d)
    base = shared_folder(spark, "stream")
    rows.write.parquet(f"{base}/inbox")
    query = start_clip_stream(
        spark, f"{base}/inbox", boundary(spark, d), f"{base}/out", f"{base}/progress", rows.schema, ranks=TAXA
    )
    query.awaitTermination()
    return _rounded(spark.read.parquet(f"{base}/out"))


@check("q_request_region", f"""
WITH v AS (SELECT lon, lat, {AX} AS x, {AY} AS y FROM ({VERTICES_SQL}))
SELECT DISTINCT round(lon, 9) AS lon, round(lat, 9) AS lat FROM (
  SELECT a.lon, a.lat FROM v a JOIN v b ON a.x <> b.x OR a.y <> b.y CROSS JOIN v c
  GROUP BY a.lon, a.lat, b.lon, b.lat
  HAVING min((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)) >= 0)
""")
def q_request_region(spark, d):
    """A vertex is a corner if a line from it to another leaves all vertices on one side."""
    return _corners(request_region(boundary(spark, d))).select("lon", "lat")


@check("q_request_regions", f"""
SELECT n_nationkey, round(lon, 9) AS lon, round(lat, 9) AS lat
FROM ({VERTICES_SQL}) WHERE i IN (0, 1, 3, 5)
""")
def q_request_regions(spark, d):
    return _corners(request_region(boundary(spark, d), per_polygon=True))


def _corners(hull):
    ring = F.slice(F.col("rings")[0], 1, F.size(F.col("rings")[0]) - 1)
    corners = hull.select(F.col("pid").alias("n_nationkey"), F.explode(ring).alias("v"))
    return corners.select("n_nationkey", F.round("v.x", 9).alias("lon"), F.round("v.y", 9).alias("lat"))


def _request_history(spark, d):
    """Each event as an earlier request: of this region, of another, or of more."""
    key = F.col("event_id")
    region = request_region(boundary(spark, d)).select(polygon_wkt("rings")).scalar()
    quality = predicate_table(spark, DEFAULT_QUALITY).groupBy("type", "key").agg(F.collect_list("value").alias("values"))
    defaults = quality.agg(
        F.collect_list(F.struct("type", "key", "values", F.lit(None).cast("string").alias("geometry")))
    ).scalar()
    none = F.lit(None).cast("string")
    part = lambda kind, name, values, shape: F.array(
        F.struct(F.lit(kind).alias("type"), name.alias("key"), values.cast("array<string>").alias("values"), shape.alias("geometry"))
    )
    here = part("within", none, F.array(), F.when(key % 3 == 0, region).otherwise("POLYGON ((0 0, 1 0, 1 1, 0 0))"))
    more = part("equals", F.lit("TAXON_KEY"), F.array(F.lit("212")), none)
    asked = F.concat(defaults, here)
    return table(spark, d, "events").select(
        key.cast("string").alias("key"),
        F.when(F.col("event_type") == "error", "CANCELLED").otherwise(REQUEST_STATUS).alias("status"),
        F.when(key % 4 == 0, "web").otherwise(REQUEST_SOURCE).alias("source"),
        F.col("ts").alias("created"),
        F.when(key % 5 == 0, F.concat(asked, more)).otherwise(asked).alias("predicates"),
    )


REUSE_CASES = {"match": "2024-02-01", "stale": "2034-02-01"}


def _reuse_sql(case: str, as_of: str) -> str:
    return f"""SELECT '{case}' AS "case", event_id::VARCHAR AS key FROM (
  SELECT event_id, ts FROM events
  WHERE event_type <> 'error' AND event_id % 4 <> 0 AND event_id % 3 = 0 AND event_id % 5 <> 0
    AND ts::DATE > DATE '{as_of}' - {REUSE_DAYS} ORDER BY ts DESC, event_id::VARCHAR LIMIT 1)"""


@check("q_request_reuse", "\nUNION ALL ".join(_reuse_sql(c, day) for c, day in REUSE_CASES.items()))
def q_request_reuse(spark, d):
    """Boundary to hull to request, compared with a history: a match, only stale ones, and none."""
    history, wanted = _request_history(spark, d), request_for_boundary(boundary(spark, d))
    elsewhere = request_for("POLYGON ((5 5, 6 5, 6 6, 5 5))")
    cases = [(c, wanted, day) for c, day in REUSE_CASES.items()] + [("none", elsewhere, REUSE_CASES["match"])]
    return bind_rows(
        *[reusable_download(spark, history, w, day).select(F.lit(c).alias("case"), "key") for c, w, day in cases]
    )


# ------------------------------------------------------------------ harmonise


def _sql_columns(**given: str) -> str:
    """All output columns; those not given are NULL."""
    kinds = {"string": "VARCHAR", "double": "DOUBLE", "integer": "INTEGER"}
    out = []
    for f in OBSERVATION_SCHEMA:
        kind = kinds[f.dataType.typeName()]
        out.append(f'({given.get(f.name, "NULL")})::{kind} AS "{f.name}"')
    return ",\n  ".join(out)


def _rounded_observations(df):
    digits = {"longitude": 9, "latitude": 9, "coordinate_uncertainty": 3, "observation_value": 6}
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


CHECK_DATASET = {
    "dataset_name": "check",
    "dataset_creator": "driver tables",
    "dataset_publisher": None,
    "dataset_url_information": None,
    "dataset_url_download": None,
    "dataset_doi": None,
    "license": "CC0 1.0",
    "group": "g",
}
CHECK_SQL = {"dataset_name": "'check'", "dataset_creator": "'driver tables'", "license": "'CC0 1.0'", "group": "'g'"}


def species_list(spark, d, codes):
    """Ranks for a column of codes: some have no species, some no kingdom."""
    size = F.length("code")
    return codes.select(
        F.lit(1).alias("no"),
        "code",
        F.concat(F.lit("Sci "), "code").alias("scientific_name"),
        F.concat(F.lit("Common "), "code").alias("common_name"),
        F.when(size != 7, "Animalia").alias("kingdom"),
        F.lit("Chordata").alias("phylum"),
        F.lit("Aves").alias("class"),
        F.concat(F.lit("O"), F.substring("code", -1, 1)).alias("order"),
        F.lit(None).cast("string").alias("family"),
        F.concat(F.lit("G"), "code").alias("genus"),
        F.when(size % 2 == 0, F.concat(F.lit("G s "), "code")).alias("species"),
    )


SPECIES_SQL = {
    "valid_scientific_name": "CASE WHEN length(code) % 2 = 0 THEN 'G s ' || code END",
    "vernacular": "CASE WHEN code IS NOT NULL THEN 'Common ' || code END",
    "kingdom": "CASE WHEN length(code) <> 7 THEN 'Animalia' END",
    "phylum": "CASE WHEN code IS NOT NULL THEN 'Chordata' END",
    "class": "CASE WHEN code IS NOT NULL THEN 'Aves' END",
    "order": "'O' || right(code, 1)",
    "genus": "'G' || code",
    "observed_rank": "CASE WHEN length(code) % 2 = 0 THEN 'species' ELSE 'genus' END",
}

_BOX_LON, _BOX_LAT = "(-137 + r_regionkey::DOUBLE * 2)", "(49 + r_regionkey::DOUBLE)"

WIDE_SQL = f"""
WITH census AS (
  SELECT CASE quarter(l_shipdate) WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' WHEN 3 THEN 'Summer' ELSE 'Autumn' END AS season,
         CASE p_brand WHEN 'Brand#1' THEN 'Total' WHEN 'Brand#2' THEN 'BT' WHEN 'Brand#3' THEN NULL ELSE p_brand END AS species,
         sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS dt,
         sum(CASE WHEN l_returnflag = 'N' AND p_size > 45 THEN l_quantity ELSE 0 END) AS mid,
         sum(CASE WHEN l_returnflag = 'R' AND p_size = 1 THEN l_quantity END) AS ub
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
long AS (
  SELECT season, species AS code, 'dt' AS site, dt / 40 AS v FROM census
  UNION ALL SELECT season, species, 'mid', mid / 40 FROM census
  UNION ALL SELECT season, species, 'ub', ub / 40 FROM census),
corner AS (
  SELECT r_regionkey, i, {_BOX_LON} + dx AS lon, {_BOX_LAT} + dy AS lat
  FROM region, (VALUES (0, 0e0, 0e0), (1, 0.01e0, 0e0), (2, 0.01e0, 0.01e0), (3, 0e0, 0.01e0)) t(i, dx, dy)),
flat AS (SELECT r_regionkey, i, {AX} AS x, {AY} AS y FROM corner),
first AS (SELECT r_regionkey, x AS x0, y AS y0 FROM flat WHERE i = 0),
size AS (SELECT a.r_regionkey, sum((a.x - x0) * (b.y - y0) - (b.x - x0) * (a.y - y0)) / 2 AS area
         FROM flat a JOIN flat b ON a.r_regionkey = b.r_regionkey AND b.i = (a.i + 1) % 4
         JOIN first f ON f.r_regionkey = a.r_regionkey GROUP BY 1),
sites AS (SELECT CASE r_regionkey WHEN 0 THEN 'dt' WHEN 1 THEN 'mid' WHEN 2 THEN 'ub' ELSE 'x' || r_regionkey END AS site,
                 {_BOX_LON} + 0.005e0 AS lon, {_BOX_LAT} + 0.005e0 AS lat, area FROM region JOIN size USING (r_regionkey))
SELECT {_sql_columns(
    **CHECK_SQL, **SPECIES_SQL,
    observation_value="round(v, 6)", observation_type="'density_ha'",
    year_obs="1974",
    month_obs="CASE season WHEN 'Spring' THEN 5 WHEN 'Summer' THEN 7 WHEN 'Autumn' THEN 9 ELSE 1 END",
    day_obs="CASE season WHEN 'Spring' THEN 6 WHEN 'Summer' THEN 13 WHEN 'Autumn' THEN 23 ELSE 15 END",
    longitude="round(lon, 9)", latitude="round(lat, 9)",
    coordinate_uncertainty="round(sqrt(area / pi()) + 10, 3)", coordinate_uncertainty_unit="'meter'",
)}
FROM sites JOIN long USING (site) WHERE v <> 0 AND code NOT IN ('Total', 'BT')
"""


@check("q_harmonise", WIDE_SQL)
def q_harmonise(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    quarter = F.quarter("l_shipdate")
    season = F.when(quarter == 1, "Winter").when(quarter == 2, "Spring").when(quarter == 3, "Summer").otherwise("Autumn")
    brand = F.col("p_brand")
    species = F.when(brand == "Brand#1", "Total").when(brand == "Brand#2", "BT").when(brand != "Brand#3", brand)
    flag, size = F.col("l_returnflag"), F.col("p_size")
    census = lines.groupBy(season.alias("season"), species.alias("species")).agg(
        F.sum(F.when(flag == "A", F.col("l_quantity"))).alias("dt"),
        F.sum(F.when((flag == "N") & (size > 45), F.col("l_quantity")).otherwise(0.0)).alias("mid"),
        F.sum(F.when((flag == "R") & (size == 1), F.col("l_quantity"))).alias("ub"),
    )
    key = F.col("r_regionkey")
    x0, y0 = F.lit(-137) + key.cast("double") * 2, F.lit(49) + key.cast("double")
    name = F.when(key == 0, "Place_DT").when(key == 1, "Place_MID").when(key == 2, "Place_UB")
    sites = table(spark, d, "region").select(
        F.coalesce(name, F.concat(F.lit("x"), key)).alias("name"),
        F.lit("POLYGON").alias("geometry_type"),
        F.array(box_ring(x0, y0, x0 + 0.01, y0 + 0.01)).alias("rings"),
        F.lit(4326).alias("srid"),
    )
    codes = table(spark, d, "part").select(F.col("p_brand").alias("code")).distinct()
    done = wide_census_observations(
        census,
        sites,
        species_list(spark, d, codes),
        {**CHECK_DATASET, "observation_type": "density_ha"},
        site_prefix="Place_",
    )
    return _rounded_observations(done)


LONG_SQL = f"""
WITH filled AS (
  SELECT event_id, user_id, event_type, value,
         last_value(CASE WHEN event_id % 20 = 0 THEN ts::DATE END IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS day
  FROM events),
long AS (
  SELECT *, try_cast((1900 + y)::VARCHAR || strftime(day, '-%m-%d') AS DATE) AS date,
         CASE y WHEN 97 THEN CASE WHEN event_id % 11 <> 0 THEN (event_id % 4)::DOUBLE END
                ELSE (event_id % 3)::DOUBLE END AS abundance,
         CASE event_type WHEN 'error' THEN 'err' WHEN 'signup' THEN NULL ELSE event_type END AS code
  FROM filled, (VALUES (97), (98)) t(y))
SELECT {_sql_columns(
    **CHECK_SQL, **SPECIES_SQL,
    observation_value="round(abundance, 6)", observation_type="'abundance'",
    year_obs="year(date)", month_obs="month(date)", day_obs="day(date)",
    longitude="round(lon, 9)", latitude="round(lat, 9)",
    coordinate_uncertainty="10", coordinate_uncertainty_unit="'meter'",
)}
FROM (SELECT n_nationkey, {CENTRE_LON_SQL} AS lon, {CENTRE_LAT_SQL} AS lat FROM nation WHERE n_nationkey NOT IN (3, 5, 24))
JOIN long ON user_id % 25 = n_nationkey WHERE abundance <> 0
"""


def _nation_points(spark, d, name):
    x, y = centre()
    return table(spark, d, "nation").select(
        name.alias("name"),
        F.lit("POINT").alias("geometry_type"),
        F.array(F.array(point(x, y))).alias("rings"),
        F.lit(4326).alias("srid"),
    )


def _event_species(spark, d):
    codes = table(spark, d, "events").where("event_type <> 'signup'").select(
        F.when(F.col("event_type") == "error", "err").otherwise(F.col("event_type")).alias("code")
    )
    return species_list(spark, d, codes.distinct()).drop("no")


@check("q_harmonise_long", LONG_SQL)
def q_harmonise_long(spark, d):
    events, key = table(spark, d, "events"), F.col("event_id")
    plot = F.col("user_id") % 25
    census = events.select(
        "event_id",
        F.when(plot == 24, "edge pt").otherwise(F.concat(plot.cast("string"), F.lit("n"))).alias("point_number"),
        F.when(key % 20 == 0, F.col("ts").cast("date")).alias("date"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("species"),
        F.when(key % 11 == 0, ".").otherwise((key % 4).cast("string")).alias("abundance_97"),
        (key % 3).cast("double").alias("abundance_98"),
    )
    nation = F.col("n_nationkey")
    name = F.when(nation == 3, "n3 omit").when(nation == 5, "n44a").otherwise(F.concat(F.lit("n"), nation))
    done = long_census_observations(
        with_key_chunk(census, "event_id"),
        _nation_points(spark, d, name),
        _event_species(spark, d),
        {**CHECK_DATASET, "observation_type": "abundance"},
        {"chunk": [BLOCK], "order": "event_id"},
        {"error": "err"},
    )
    return _rounded_observations(done)


PLOT_SQL = f"""
SELECT {_sql_columns(
    **CHECK_SQL, **SPECIES_SQL,
    observation_value="round(value, 6)", observation_type="'abundance'",
    year_obs="year(ts)", month_obs="month(ts)", day_obs="day(ts)",
    longitude="round(lon, 9)", latitude="round(lat, 9)",
    coordinate_uncertainty="10", coordinate_uncertainty_unit="'meter'",
)}
FROM (SELECT n_nationkey, {CENTRE_LON_SQL} AS lon, {CENTRE_LAT_SQL} AS lat FROM nation WHERE n_nationkey < 24)
JOIN (SELECT *, CASE event_type WHEN 'error' THEN 'err' WHEN 'signup' THEN NULL ELSE event_type END AS code FROM events)
  ON user_id % 25 = n_nationkey
WHERE value <> 0
"""


@check("q_harmonise_plots", PLOT_SQL)
def q_harmonise_plots(spark, d):
    kind = F.col("event_type")
    census = table(spark, d, "events").select(
        F.concat(F.lit("plot"), F.col("user_id") % 25).alias("plot"),
        F.when(kind == "error", "err").when(kind != "signup", kind).alias("species"),
        F.col("value").alias("abundance"),
        F.col("ts").cast("date").alias("date"),
    )
    plots = {f"NATION_{i}": f"plot{i}" for i in range(24)}
    done = plot_census_observations(
        census,
        _nation_points(spark, d, F.col("n_name")),
        _event_species(spark, d),
        {**CHECK_DATASET, "observation_type": "abundance"},
        plots,
    )
    return _rounded_observations(done)


# metres per unit of the rectifying sphere
K = f"({ZONE_SCALE} * {RECTIFYING_RADIUS})"


def _series(terms, angle, form):
    return " ".join(form.format(c=c, k=2 * j, a=angle) for j, c in enumerate(terms, start=1))


STREAM_SQL = f"""
WITH grid AS (
  SELECT n_name, (n_nationkey * 3650)::DOUBLE / {K} AS e, (5427000 + n_nationkey * 2200)::DOUBLE / {K} AS n FROM nation),
sphere AS (
  SELECT n_name,
         n {_series(BACKWARD, "n", "- {c} * sin({k} * {a}) * cosh({k} * e)")} AS xi,
         e {_series(BACKWARD, "n", "- {c} * cos({k} * {a}) * sinh({k} * e)")} AS eta FROM grid),
conformal AS (SELECT n_name, asin(sin(xi) / cosh(eta)) AS chi, atan2(sinh(eta), cos(xi)) AS lam FROM sphere),
place AS (
  SELECT n_name, degrees(lam) - 123 AS lon,
         {geographic_sql("chi")} AS lat FROM conformal),
s AS (SELECT event_id, ts, 'NATION_' || (user_id % 26)::VARCHAR AS stream,
             CASE event_id % 7 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN -5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE round(value, 0) END AS m FROM events)
SELECT {_sql_columns(
    **CHECK_SQL,
    valid_scientific_name="'Sci NATION_0'", vernacular="'One'", observation_value="1", observation_type="'occurrence'",
    kingdom="(SELECT r_name FROM region WHERE r_regionkey = 0)", phylum="(SELECT n_name FROM nation WHERE n_nationkey = 0)",
    observed_rank="'species'",
    year_obs="year(ts)", month_obs="month(ts)", day_obs="day(ts)",
    longitude="round(lon, 9)", latitude="round(lat, 9)",
    coordinate_uncertainty="round(coalesce(m, (SELECT max(m) FROM s)) + 10, 3)", coordinate_uncertainty_unit="'meter'",
)}
FROM s LEFT JOIN place ON stream = n_name
"""


@check("q_harmonise_streams", STREAM_SQL)
def q_harmonise_streams(spark, d):
    key = F.col("event_id")
    case = key % 7
    number = F.round("value", 0)
    location = (
        F.when(case == 0, ".").when(case == 1, "O").when(case == 2, "minus 5").when(case == 3, "far away")
        .when(case != 4, number.cast("string"))
    )
    survey = table(spark, d, "events").select(
        F.concat(F.lit("NATION_"), F.col("user_id") % 26).alias("Stream"),
        F.col("ts").cast("date").alias("date"),
        location.alias("location_m"),
    )
    n = F.col("n_nationkey")
    east, north = 500000 + n * 3650, 5427000 + n * 2200
    name = F.when(n == 7, "NATION_7d").otherwise(F.col("n_name"))
    words = [
        (name, 0),
        (F.concat(east, F.lit("E,")), 1),
        (F.concat(north, F.lit("N")), 2),
        (F.lit("and other words"), 3),
    ]
    page = bind_rows(
        *[table(spark, d, "nation").select(w.alias("text"), (n * 4 + i).alias("ord")) for w, i in words]
    )
    backbone = bind_rows(
        table(spark, d, "region").select(
            F.col("r_regionkey").cast("bigint").alias("taxon_id"),
            F.lit(None).cast("bigint").alias("parent_id"),
            F.lit("kingdom").alias("rank"),
            F.col("r_name").alias("name"),
        ),
        table(spark, d, "nation").select(
            (F.col("n_nationkey") + 100).cast("bigint").alias("taxon_id"),
            F.col("n_regionkey").cast("bigint").alias("parent_id"),
            F.lit("phylum").alias("rank"),
            F.col("n_name").alias("name"),
        ),
    )
    meant = table(spark, d, "nation").select(
        F.concat(F.lit("Sci "), "n_name").alias("query"),
        F.lit(1).alias("candidate_rank"),
        (F.col("n_nationkey") + 100).cast("bigint").alias("taxon_id"),
    )
    done = stream_survey_observations(
        survey,
        page,
        meant,
        backbone,
        {**CHECK_DATASET, "observation_type": "occurrence", "valid_scientific_name": "Sci NATION_0", "vernacular": "One"},
        stream_fixes={"NATION_7d": "NATION_7"},
    )
    return _rounded_observations(done)
