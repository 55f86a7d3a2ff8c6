import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from bioobs.functions import projection, text, values
from bioobs.functions.projection import reproject
from bioobs.functions.rings import area_m2, centroid, closed, oriented, polygon_wkt, box_ring


def one(spark, column, **given):
    row = spark.createDataFrame([tuple(given.values()) or (1,)], list(given) or ["x"])
    return row.select(column.alias("v")).first().v


def test_first_match_only(spark):
    assert one(spark, text.remove_first("s", "a"), s="banana") == "bnana"
    assert one(spark, text.replace_first("s", ".parquet", ".txt"), s="x/a.parquet/b.parquet") == "x/a.txt/b.parquet"
    assert one(spark, text.replace_first("s", "(b)(a)", r"\2\1"), s="xbaba") == "xabba"
    assert one(spark, text.replace_first("s", "z", "y"), s="banana") == "banana"
    assert one(spark, text.remove_first("s", "b"), s="a\nb\nb") == "a\n\nb"


def test_sub_string(spark):
    assert one(spark, text.sub_string("s", -1, -1), s="12a") == "a"
    assert one(spark, text.sub_string("s", 1, -2), s="12a") == "12"
    assert one(spark, text.sub_string("s", 2, -1), s="a12") == "12"
    assert one(spark, text.sub_string("s", 2, 1), s="a12") == ""
    assert one(spark, text.sub_string("s", 2, -1), s="a") == ""


def test_paths_and_glue(spark):
    assert one(spark, text.file_stem("s"), s="a/b.c/d.e.parquet") == "d.e"
    assert one(spark, text.file_extension("s"), s="a/b.c/d") == ""
    assert one(spark, text.glue("{k}.zip", k="k"), k="007") == "007.zip"
    assert one(spark, text.keep_matching(F.array(F.lit("a.R"), F.lit("b")), r"\.R$")) == ["a.R"]


def test_clean_names():
    names = ["4-letter code", "Point Number", "abundance 97", "Time.Start", "no", "No", "%", "", "camelCase", "Espèce"]
    assert text.clean_names(names) == [
        "x4_letter_code", "point_number", "abundance_97", "time_start", "no", "no_2", "percent", "x", "camel_case", "espece",
    ]


def test_three_valued_and_recode(spark):
    null = F.lit(None).cast("string")
    assert one(spark, values.if_else(null == "a", 1, 2)) is None
    assert one(spark, values.recode_values(F.lit("b"), {"a": "x"})) is None
    assert one(spark, values.replace_values(F.lit("b"), {"a": "x"})) == "b"
    assert one(spark, values.replace_values(null, {"a": "x"})) is None
    assert one(spark, values.replace_when(F.lit("b"), (null == "a", "x"))) == "b"


def test_casts_and_dates(spark):
    for word, number in {".": None, "5d": None, "5.F": None, " 7 ": 7.0, "1e3": 1000.0, "-Inf": float("-inf")}.items():
        assert one(spark, values.as_numeric(F.lit(word))) == number
    assert one(spark, values.as_logical(F.lit("T"))) is True
    leap = F.lit("2000-02-29").cast("date")
    assert one(spark, values.rebase_year(leap, F.lit(1997.0))) is None
    assert one(spark, values.rebase_year(leap, F.lit(1996.0))) == dt.date(1996, 2, 29)
    assert one(spark, values.rebase_year(F.lit(None).cast("date"), F.lit(1996.0))) is None
    day = F.lit("2024-03-31").cast("date")
    assert one(spark, values.newer_than(day, "2024-04-29", 30)) is True
    assert one(spark, values.newer_than(day, "2024-04-30", 30)) is False


def meridian_arc(lat):
    """Metres from the equator by numeric integration."""
    f = 1 / 298.257222101
    e2, a, n = f * (2 - f), 6378137.0, 200_000
    h = math.radians(lat) / n
    m = lambda p: a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
    inner = sum((4 if i % 2 else 2) * m(i * h) for i in range(1, n))
    return (m(0) + m(n * h) + inner) * h / 3


def test_projection_control_points(spark):
    x, y = reproject("lon", "lat", 4326, 3005)
    east, north = reproject("lon", "lat", 4326, 32610)
    rows = spark.createDataFrame([(-126.0, 45.0), (-123.0, 49.0)], "lon double, lat double")
    a, b = rows.select(x.alias("x"), y.alias("y"), east.alias("e"), north.alias("n")).collect()
    assert abs(a.x - 1e6) < 1e-6 and abs(a.y) < 1e-6
    # the central meridian of the zone is the meridian arc, shrunk
    assert abs(b.e - 500_000) < 1e-6 and abs(b.n - 0.9996 * meridian_arc(49.0)) < 1e-3


def test_published_points_off_the_central_meridian(spark, monkeypatch):
    # zone 17: 43°38'33.24"N 79°23'13.7"W is 630084 m east, 4833438 m north; mirrored west of the meridian
    lon, lat = -(79 + 23 / 60 + 13.7 / 3600), 43 + 38 / 60 + 33.24 / 3600
    rows = spark.createDataFrame([(lon, lat), (-162.0 - lon, lat)], "lon double, lat double")
    x, y = projection.TransverseMercator(lon_0=-81.0).forward("lon", "lat")
    east, west = rows.select(x.alias("x"), y.alias("y")).collect()
    assert abs(east.x - 630_084) < 1 and abs(east.y - 4_833_438) < 1
    assert abs(west.x - (1_000_000 - 630_084)) < 1 and abs(west.y - 4_833_438) < 1
    # Snyder's example of the conic, on the ellipsoid of Clarke 1866
    monkeypatch.setattr(projection, "A", 6378206.4)
    monkeypatch.setattr(projection, "E2", 0.00676866)
    monkeypatch.setattr(projection, "E", math.sqrt(0.00676866))
    conic = projection.EqualAreaConic(lat_0=23.0, lon_0=-96.0, lat_1=29.5, lat_2=45.5, x_0=0.0)
    x, y = conic.forward("lon", "lat")
    places = spark.createDataFrame([(-75.0, 35.0), (-117.0, 35.0)], "lon double, lat double")
    east, west = places.select(x.alias("x"), y.alias("y")).collect()
    assert abs(east.x - 1_885_472.7) < 0.1 and abs(east.y - 1_535_925.0) < 0.1
    assert abs(west.x + 1_885_472.7) < 0.1 and abs(west.y - 1_535_925.0) < 0.1


def test_projection_keeps_scale_on_standard_parallels(spark):
    f = 1 / 298.257222101
    e2 = f * (2 - f)
    rows = spark.createDataFrame([(50.0,), (58.5,)], "lat double")
    step = 1e-4
    x1, y1 = reproject(F.lit(-120.0), "lat", 4326, 3005)
    x2, y2 = reproject(F.lit(-120.0 + step), "lat", 4326, 3005)
    for r in rows.select("lat", F.hypot(x2 - x1, y2 - y1).alias("d")).collect():
        p = math.radians(r.lat)
        true = 6378137.0 * math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2) * math.radians(step)
        assert abs(r.d / true - 1) < 1e-7


def test_projection_keeps_area(spark):
    """A cell of the globe has its exact area, known from the authalic integral."""
    f = 1 / 298.257222101
    e = math.sqrt(f * (2 - f))

    def belt(lat):  # area between equator and latitude per radian of longitude
        s = math.sin(math.radians(lat))
        b2 = 6378137.0**2 * (1 - e * e)
        return b2 / 2 * (s / (1 - e * e * s * s) + math.log((1 + e * s) / (1 - e * s)) / (2 * e))

    w, s0 = 0.01, 54.0
    box = F.array(box_ring(F.lit(-125.0), F.lit(s0), F.lit(-125.0 + w), F.lit(s0 + w)))
    true = (belt(s0 + w) - belt(s0)) * math.radians(w)
    assert abs(one(spark, area_m2(box)) / true - 1) < 1e-6


@pytest.mark.parametrize(
    "srid, box",
    [(3005, (300_000, 400_000, 1_900_000, 1_700_000)), (32610, (200_000, 5_300_000, 900_000, 6_600_000)),
     (32610, (600_000, -2_000_000, 1_400_000, 1_000_000))],
)
def test_envelope_contains(spark, srid, box):
    x0, y0, x1, y1 = box
    w, s, e, n = projection.PROJECTIONS[srid].lon_lat_envelope(x0, y0, x1, y1)
    assert e - w < 60
    grid = spark.range(101 * 101).select(
        (x0 + (F.col("id") % 101) * (x1 - x0) / 100).alias("x"), (y0 + F.floor(F.col("id") / 101) * (y1 - y0) / 100).alias("y")
    )
    lon, lat = reproject("x", "y", srid, 4326)
    outside = grid.select(lon.alias("lon"), lat.alias("lat")).where(
        ~(F.col("lon").between(w, e) & F.col("lat").between(s, n))
    )
    assert outside.count() == 0


def test_ring_measures(spark):
    outer = box_ring(*map(F.lit, (0.0, 0.0, 4.0, 4.0)))
    hole = box_ring(*map(F.lit, (0.0, 0.0, 2.0, 2.0)))
    rings = F.array(oriented(F.reverse(outer), hole=False), oriented(hole, hole=True))
    # 12 = 16 - 4; the hole's centre (1,1) pulls the centroid away: (16*2 - 4*1) / 12
    got = one(spark, centroid(rings))
    assert got.x == pytest.approx(28 / 12) and got.y == pytest.approx(28 / 12)
    lone = F.array(F.array(F.struct(F.lit(3.0).alias("x"), F.lit(5.0).alias("y"))))
    assert one(spark, centroid(lone)["x"]) == 3.0
    assert one(spark, polygon_wkt(F.array(closed(F.slice(outer, 1, 4))))) == "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 4.0, 0.0 0.0))"


def test_unknown_projection():
    with pytest.raises(ValueError):
        reproject("x", "y", 4326, 9999)
