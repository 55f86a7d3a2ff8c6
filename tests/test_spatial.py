import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from bioobs.operators import spatial
from bioobs.operators.spatial import (
    cell_table,
    cell_tests,
    convex_hull,
    edges,
    fit_grid,
    hull_ring,
    points_in_polygons,
    tag_points,
    with_srid,
)
from bioobs.plans.occurrence import clip_to_boundary
from bioobs.schemas import GEOMETRY_SCHEMA

BOUNDARY = T.StructType([T.StructField("polygon_id", T.IntegerType()), *GEOMETRY_SCHEMA])


def polygon(number, *rings, srid=3005):
    return (number, "POLYGON", [[(float(x), float(y)) for x, y in r] for r in rings], srid)


def square(x, y, w):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


def star(cx, cy, n, low, high):
    step = 2 * math.pi / n
    radius = [random.uniform(low, high) for _ in range(n)]
    return [(cx + r * math.cos(i * step), cy + r * math.sin(i * step)) for i, r in enumerate(radius)]


def brute(rings, px, py):
    hits, on = np.zeros(len(px), int), np.zeros(len(px), bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if y1 != y2:
                hits += ((y1 > py) != (y2 > py)) & (px < x1 + (py - y1) * (x2 - x1) / (y2 - y1))
            on |= (
                ((x2 - x1) * (py - y1) == (y2 - y1) * (px - x1))
                & (px >= min(x1, x2)) & (px <= max(x1, x2)) & (py >= min(y1, y2)) & (py <= max(y1, y2))
            )
    return (hits % 2 == 1) | on


@pytest.fixture(scope="module")
def scene(spark):
    random.seed(11)
    polygons = [
        polygon(1, star(50, 50, 800, 25, 45), star(50, 50, 40, 3, 15)),
        polygon(2, square(80, 80, 20), square(85, 85, 5)),
        polygon(3, star(20, 80, 37, 1, 25)),
        polygon(4, [(0, 0), (100, 1e-9), (100, 0)]),  # a sliver
        polygon(5, [(10, 10), (30, 10), (30, 30), (20, 12), (10, 30)]),
        # nearly level edges that straddle the borders of rows
        polygon(6, [(0, 40), (100, 40 + 1e-13), (100, 60 - 1e-12), (50, 60 + 1e-12), (0, 60)]),
    ]
    rng = np.random.default_rng(4)
    corners = np.array([v for p in polygons for r in p[2] for v in r])
    xs = np.concatenate([rng.uniform(-5, 105, 6000), rng.integers(0, 106, 3000), corners[:, 0], (corners[:-1, 0] + corners[1:, 0]) / 2])
    ys = np.concatenate([rng.uniform(-5, 105, 6000), rng.integers(0, 106, 3000), corners[:, 1], (corners[:-1, 1] + corners[1:, 1]) / 2])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(xs, ys))], "id long, x double, y double")
    inside = {p[0]: set(np.nonzero(brute(p[2], xs, ys))[0].tolist()) for p in polygons}
    return spark.createDataFrame(polygons, BOUNDARY), points, inside


@pytest.mark.parametrize("limit", [64 * 2**20, 0], ids=["broadcast", "shuffled"])
def test_points_in_polygons_equals_brute_force(scene, limit):
    polygons, points, inside = scene
    got = [r.id for r in points_in_polygons(points, polygons, broadcast_bytes=limit).collect()]
    assert len(got) == len(set(got)) and set(got) == set().union(*inside.values())
    tagged = tag_points(points, polygons, broadcast_bytes=limit).collect()
    assert len(tagged) == sum(map(len, inside.values()))
    for number, ids in inside.items():
        assert {r.id for r in tagged if r.polygon_id == number} == ids


@pytest.mark.parametrize("most", [1, 3])
def test_crowded_cells_are_halved(scene, monkeypatch, most):
    """However often cells are halved, the answer is that of every edge tested."""
    polygons, points, inside = scene
    monkeypatch.setattr(spatial, "MANY_SIDES", 0)
    monkeypatch.setattr(spatial, "CROWDED", most)
    sides = edges(polygons)
    grid = fit_grid(sides)
    crowded = spatial.crowded_cells(cell_tests(sides, grid), grid)
    assert crowded.count() and crowded.agg(F.max("halvings")).first()[0] <= spatial.FINEST
    assert spatial.crowded_cells(cell_tests(sides, grid), grid, broadcast_bytes=10) is None
    tagged = tag_points(points, polygons)
    assert tagged.columns == points.columns + ["polygon_id"]
    tagged = tagged.collect()
    assert len(tagged) == sum(map(len, inside.values()))
    for number, ids in inside.items():
        assert {r.id for r in tagged if r.polygon_id == number} == ids
    kept = points_in_polygons(points, polygons)
    assert kept.columns == points.columns
    got = [r.id for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == set().union(*inside.values())


@pytest.mark.parametrize("limit", [64 * 2**20, 0], ids=["broadcast", "shuffled"])
def test_edges_holes_and_bad_points(spark, limit):
    polygons = spark.createDataFrame([polygon(1, square(0, 0, 10), square(4, 4, 2)), polygon(2, square(5, 5, 10))], BOUNDARY)
    data = [
        ("inside", 1.0, 1.0), ("outside", -1.0, 5.0), ("hole", 4.5, 4.5), ("edge", 0.0, 3.0), ("corner", 10.0, 0.0),
        ("hole edge", 4.0, 5.0), ("both", 7.0, 7.0), ("nan", float("nan"), 5.0), ("inf", 5.0, float("inf")),
        ("null", None, 5.0), ("twice", 2.0, 2.0), ("twice", 2.0, 2.0),
    ]
    points = spark.createDataFrame(data, "what string, x double, y double")
    got = sorted(r.what for r in points_in_polygons(points, polygons, broadcast_bytes=limit).collect())
    assert got == ["both", "corner", "edge", "hole edge", "inside", "twice", "twice"]
    none = polygons.where("polygon_id = 9")
    assert points_in_polygons(points, none).count() == 0 and tag_points(points, none).count() == 0


def test_clip_keeps_or_rejects_every_record(spark):
    boundary = spark.createDataFrame([polygon(1, square(1_000_000, 400_000, 500_000))], BOUNDARY)
    ranks = ["kingdom", "phylum", "class", "order", "family", "genus", "species"]
    data = [(None,) * 7 + (-126.0 + i / 10, 48.0 + j / 10) for i in range(80) for j in range(80)] + [(None,) * 7 + (None, 50.0)]
    names = ", ".join(f"`{r}` string" for r in ranks) + ", decimallongitude double, decimallatitude double"
    occurrence = spark.createDataFrame(data, names)
    clipped = clip_to_boundary(occurrence, boundary)
    kept = clipped.collect()
    assert 0 < len(kept) < len(data)
    assert all(1_000_000 <= r.x <= 1_500_000 and 400_000 <= r.y <= 900_000 for r in kept)
    assert {r.kingdom for r in kept} == {"unknown"} and "decimallongitude" not in clipped.columns
    assert clip_to_boundary(occurrence, boundary.where("false")).columns == clipped.columns
    with pytest.raises(Exception, match="expected EPSG:3005"):
        clip_to_boundary(occurrence, with_srid(boundary, 4326)).collect()


def test_hull_contains_all_and_is_convex(spark):
    rng = np.random.default_rng(8)
    data = [(g, float(x), float(y)) for g in (1, 2) for x, y in rng.integers(-1000, 1000, (5000, 2))]
    points = spark.createDataFrame(data, "g int, x double, y double").repartition(5)
    hull = convex_hull(points, "g").orderBy("g", "corner").collect()
    for g in (1, 2):
        ring = [(r.x, r.y) for r in hull if r.g == g]
        n = len(ring)
        mine = np.array([(x, y) for k, x, y in data if k == g])
        for i in range(n):
            (ax, ay), (bx, by), (cx, cy) = ring[i], ring[(i + 1) % n], ring[(i + 2) % n]
            assert (bx - ax) * (cy - by) - (by - ay) * (cx - bx) > 0
            assert ((bx - ax) * (mine[:, 1] - ay) - (by - ay) * (mine[:, 0] - ax) >= 0).all()


def test_hull_of_few_points(spark):
    data = [("one", 1.0, 1.0), ("one", 1.0, 1.0), ("line", 0.0, 0.0), ("line", 1.0, 1.0), ("line", 2.0, 2.0), ("null", None, 1.0)]
    hull = convex_hull(spark.createDataFrame(data, "g string, x double, y double"), "g")
    assert sorted((r.g, r.x) for r in hull.collect()) == [("line", 0.0), ("line", 2.0), ("one", 1.0)]
    rings = {r.g: r.rings for r in hull_ring(hull, "g").collect()}
    assert [v.x for v in rings["line"][0]] == [0.0, 2.0, 0.0]


def test_long_outline(spark, tmp_path):
    """Sides of one outline lie on many tasks, and its grid may be finer than any fixed size."""
    random.seed(5)
    n = 70_000
    ring = star(0.0, 0.0, n, 90.0, 91.0)
    spark.createDataFrame([polygon(1, ring)], BOUNDARY).write.parquet(str(tmp_path / "outline"))
    outline = spark.read.parquet(str(tmp_path / "outline"))
    sides = edges(outline)
    assert sides.count() == n and sides.rdd.getNumPartitions() > 1
    grid = fit_grid(sides, 2**40)
    assert grid.side == int(2 * n**0.5)
    coarse = fit_grid(sides, 2**25)
    assert coarse.side < grid.side
    rng = np.random.default_rng(6)
    angle, radius = rng.uniform(0, 2 * math.pi, 300), rng.uniform(88, 93, 300)
    xs, ys = radius * np.cos(angle), radius * np.sin(angle)
    wanted = set(np.nonzero(brute([ring], xs, ys))[0].tolist())
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(xs, ys))], "id long, x double, y double")
    for size in (2**40, 2**25, 0):
        assert {r.id for r in points_in_polygons(points, outline, broadcast_bytes=size).collect()} == wanted
    tests = cell_tests(sides, coarse)
    most = F.max(F.size("near"))
    assert cell_table(tests, coarse).agg(most).first()[0] > spatial.CROWDED
    halved = spatial.halved_tests(tests, spatial.crowded_cells(tests, coarse, 2**40), coarse)
    assert 0 < cell_table(halved, coarse).agg(most).first()[0] <= spatial.CROWDED
