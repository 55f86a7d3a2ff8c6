"""Points in polygons and convex hulls over large point tables.

**Grid test.** A grid is laid over the boundary. For every cell three things
decide whether a point in it is inside, by the even-odd rule on a ray to +x:

* the few edges that pass near the cell (tested one by one),
* the y values at which edges further right start or end within the cell's row;
  a vertex shared by two such edges occurs twice and cancels, so only the places
  where the outline enters or leaves the cell's right-hand side remain,
* one bit for edges further right that reach above the row.

Cells without any of these are outside and absent from the table; cells with the
bit alone are inside. The answer equals testing every edge, because cell numbers
come from a monotone function of the coordinate. Points join the cells by number:
a left semi join, so a point never multiplies, needs no id and is not grouped.

**Crowded cells.** Where more than ``CROWDED`` edges pass near a cell, it is halved
both ways as often as their number asks for. The number of a small cell begins with
that of the cell it is part of, so a point first looks up how often its cell was
halved and then finds the small one: two lookups, whatever the outline.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from bioobs.functions.projection import PROJECTIONS
from bioobs.functions.rings import crosses_right, on_segment, ring_edges
from bioobs.operators.shape import named
from bioobs.session import shared_folder

# The cell table is copied to every executor up to this size, bounded beforehand.
BROADCAST_BYTES = 256 * 1024 * 1024
# Part of a cell by which a clipped edge is widened, far above any rounding.
SLACK = 0.05
# A cell with more edges than this is halved, FINEST times at most; a boundary of no
# more than MANY_SIDES sides is not looked through for such cells.
CROWDED = 64
FINEST = 10
MANY_SIDES = 4096


def _power(halvings) -> Column:
    return F.lit(2.0**halvings) if isinstance(halvings, int) else F.pow(F.lit(2.0), halvings)


@dataclass(frozen=True)
class Grid:
    """Cells over a bounding box, and whether its cell table fits a broadcast.

    ``outline`` is the number of polygon sides. ``halvings`` is how often the cells
    meant are halved: a number or a column.
    """

    x_min: float
    y_min: float
    x_max: float
    y_max: float
    side: int
    small: bool = True
    outline: int = 0

    @property
    def width(self) -> float:
        return (self.x_max - self.x_min) / self.side or 1.0

    @property
    def height(self) -> float:
        return (self.y_max - self.y_min) / self.side or 1.0

    def _step(self, v: Column, low: float, size: float, halvings) -> Column:
        # cut from the number of the finest cell, so that cells nest exactly
        finest = F.floor((v - low) / (size / 2**FINEST))
        return F.floor(finest / _power(FINEST - halvings))

    def cell(self, x: Column, halvings=0) -> Column:
        return self._step(x, self.x_min, self.width, halvings)

    def row(self, y: Column, halvings=0) -> Column:
        return self._step(y, self.y_min, self.height, halvings)

    def number(self, row: Column, cell: Column, halvings=0) -> Column:
        """One number per cell, of every size; NULL outside."""
        across = (F.lit(self.side + 1) * _power(halvings)).cast("long")
        inside = (row >= 0) & (row < across) & (cell >= 0) & (cell < across)
        return F.when(inside, (row * across + cell) * (FINEST + 1) + halvings)

    def number_at(self, x: Column, y: Column, halvings=0) -> Column:
        """Number of the cell that holds a point; NaN lies nowhere."""
        known = lambda v: F.nanvl(v, F.lit(None).cast("double"))
        return self.number(self.row(known(y), halvings), self.cell(known(x), halvings), halvings)

    def covers(self, x: Column, y: Column) -> Column:
        return x.between(self.x_min, self.x_max) & y.between(self.y_min, self.y_max)


def with_srid(df: DataFrame, srid: int) -> DataFrame:
    """Declare the coordinate system; coordinates stay as they are."""
    return df.withColumn("srid", F.lit(srid))


def expecting_srid(polygons: DataFrame, srid: int) -> DataFrame:
    """The polygons, or an error when they run if one is in another system."""
    wrong = F.raise_error(F.format_string(f"polygon in EPSG:%d, expected EPSG:{srid}", "srid"))
    return polygons.withColumn("rings", F.when(F.col("srid") == srid, F.col("rings")).otherwise(wrong))


def edges(polygons: DataFrame, polygon_id: str = "polygon_id") -> DataFrame:
    """One row per polygon side: ``pid, x1, y1, x2, y2``.

    A long outline is one row of the boundary; its sides are dealt over all tasks.
    """
    rings = polygons.select(named(polygon_id).alias("pid"), F.explode("rings").alias("ring"))
    sides = rings.select("pid", F.explode(ring_edges(F.col("ring"))).alias("e"))
    plain = sides.select(
        "pid",
        F.col("e.a.x").alias("x1"),
        F.col("e.a.y").alias("y1"),
        F.col("e.b.x").alias("x2"),
        F.col("e.b.y").alias("y2"),
    )
    # a stated number: adaptive execution would merge so few bytes, and their many cells, into one task
    tasks = polygons.sparkSession.sparkContext.defaultParallelism
    return plain.repartition(tasks, "x1", "y1", "x2", "y2")


def fit_grid(sides: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Grid | None:
    """Choose the grid from one one-row aggregate over the polygon sides."""
    wide, tall = F.col("right") - F.col("left"), F.col("top") - F.col("low")
    total = (
        sides.groupBy("pid")
        .agg(
            F.min(F.least("x1", "x2")).alias("left"),
            F.min(F.least("y1", "y2")).alias("low"),
            F.max(F.greatest("x1", "x2")).alias("right"),
            F.max(F.greatest("y1", "y2")).alias("top"),
            F.sum(F.abs(F.col("x1") - F.col("x2"))).alias("dx"),
            F.sum(F.abs(F.col("y1") - F.col("y2"))).alias("dy"),
            F.count("*").alias("n"),
        )
        .agg(
            F.min("left").alias("left"),
            F.min("low").alias("low"),
            F.max("right").alias("right"),
            F.max("top").alias("top"),
            F.sum(wide).alias("wide"),
            F.sum(tall).alias("tall"),
            F.sum(wide * tall).alias("area"),
            F.sum("dx").alias("dx"),
            F.sum("dy").alias("dy"),
            F.sum("n").alias("n"),
            F.count("*").alias("polygons"),
        )
        .first()
    )
    if not total.n:
        return None
    corner = (total.left, total.low, total.right, total.top)
    finest = max(16, int(2 * total.n**0.5))

    def fitted(side: int) -> Grid:
        grid = Grid(*corner, side, outline=total.n)
        w, h = grid.width, grid.height
        # upper bounds: a polygon's box in cells, and the cells that its sides pass near
        cells = total.area / (w * h) + 2 * (total.wide / w + total.tall / h) + 4 * total.polygons
        entries = 2 * total.dx / w + 2 * total.dy / h + 4 * total.n
        return replace(grid, small=cells * 64 + entries * 48 <= broadcast_bytes)

    # a jagged outline passes many cells: one up to four times coarser spares moving the points
    options = [fitted(finest), fitted(max(16, finest // 2)), fitted(max(16, finest // 4))]
    return next((g for g in options if g.small), options[0])


def _clipped(per_row: DataFrame, grid: Grid, halvings=0) -> DataFrame:
    """Adds ``c0, c1``: the first and the last cell of ``row`` that a side passes near."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    left, right = F.least("x1", "x2"), F.greatest("x1", "x2")
    width, height = F.lit(grid.width) / _power(halvings), F.lit(grid.height) / _power(halvings)

    def x_at(y: Column) -> Column:
        inside = F.least(F.greatest(y, low), high)
        rise = F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
        return F.col("x1") + (inside - F.col("y1")) * (F.col("x2") - F.col("x1")) / rise

    bottom = F.lit(grid.y_min) + F.col("row") * height
    xa, xb = x_at(bottom), x_at(bottom + height)
    # a nearly level edge is not clipped: where it meets a row's border is ill-defined
    level = high - low < height * 1e-3
    reach = width * SLACK
    return per_row.withColumns(
        {
            "c0": grid.cell(F.when(level, left).otherwise(F.greatest(left, F.least(xa, xb) - reach)), halvings),
            "c1": grid.cell(F.when(level, right).otherwise(F.least(right, F.greatest(xa, xb) + reach)), halvings),
        }
    )


def _ends(pieces: DataFrame, grid: Grid, keys: list[str], halvings=0) -> DataFrame:
    """``row, c0, y``: heights in a row at which points left of ``c0`` change sides; infinite above it."""

    def end(y: str) -> Column:
        r = grid.row(F.col(y), halvings)
        return F.when(r > F.col("row"), F.lit(float("inf"))).when(r == F.col("row"), F.col(y))

    return (
        pieces.where(F.col("y1") != F.col("y2"))
        .select(*keys, "row", "c0", F.explode(F.array(end("y1"), end("y2"))).alias("y"))
        .where(F.col("y").isNotNull())
    )


def _far(ends: DataFrame, keys: list[str], first: Column) -> DataFrame:
    """Tests for the ends of edges right of a cell, from the cell ``first`` on.

    An end matters where an odd number of edges right of the cell has it: from each
    odd one in order from the right, up to the next. Only these cells are ever listed.
    """
    once = ends.groupBy(*keys, "row", "y", "c0").count().where("count % 2 = 1")
    leftward = Window.partitionBy(*keys, "row", "y").orderBy(F.col("c0").desc())
    runs = once.withColumns(
        {"turn": F.row_number().over(leftward), "stop": F.coalesce(F.lead("c0", 1).over(leftward), first)}
    ).where("turn % 2 = 1")
    return runs.select(
        *keys, "row", F.explode(F.sequence("stop", F.col("c0") - 1)).alias("cell"),
        F.when(F.col("y") == float("inf"), "above").otherwise("start").alias("kind"),
        F.lit(None).cast("double").alias("x1"), F.col("y").alias("y1"),
        F.lit(None).cast("double").alias("x2"), F.lit(None).cast("double").alias("y2"),
    )


def cell_tests(sides: DataFrame, grid: Grid) -> DataFrame:
    """Rows ``pid, row, cell, kind, x1..y2``: what a point of a cell must check.

    ``kind`` is ``edge`` (test it), ``start`` (flips the answer for points below
    ``y1``) or ``above`` (flips it for the whole cell).
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    pieces = _clipped(sides.withColumn("row", F.explode(F.sequence(grid.row(low), grid.row(high)))), grid)
    near = pieces.select(
        "pid", "row", F.explode(F.sequence("c0", "c1")).alias("cell"),
        F.lit("edge").alias("kind"), "x1", "y1", "x2", "y2",
    )
    ends = _ends(pieces.where(F.col("c0") > 0), grid, ["pid"])
    return near.unionByName(_far(ends, ["pid"], F.lit(0)))


def crowded_cells(tests: DataFrame, grid: Grid, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``number, halvings`` of the cells to halve; None if there are none.

    A stored table of at most one row per cell of the grid. The small cells, bounded
    from above, take at most ``broadcast_bytes``: cells are halved fewer times, or not
    at all, where they would take more.
    """
    spark = tests.sparkSession
    edge = F.col("kind") == "edge"
    passed = F.least(F.abs(F.col("x1") - F.col("x2")) / grid.width, F.lit(1.0)) + F.least(
        F.abs(F.col("y1") - F.col("y2")) / grid.height, F.lit(1.0)
    )
    per_cell = tests.groupBy(grid.number(F.col("row"), F.col("cell")).alias("number"), "pid").agg(
        F.count(F.when(edge, 1)).alias("edges"),
        F.sum(F.when(edge, passed)).alias("passed"),
        F.count(F.when(~edge, 1)).alias("ends"),
    )
    # twice as many cells across as the edges ask for, because they are not spread evenly
    halvings = F.least(F.lit(FINEST), F.ceil(F.log2(F.max("edges") / CROWDED)).cast("int") + 1).alias("halvings")
    found = (
        per_cell.groupBy("number")
        .agg(
            halvings, F.max("edges").alias("most"), F.count("*").alias("polygons"),
            F.sum("edges").alias("edges"), F.sum("passed").alias("passed"), F.sum("ends").alias("ends"),
        )
        .where(F.col("most") > CROWDED)
    )
    path = shared_folder(spark, "crowded-cells")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)

    def size(most: int) -> Column:
        times = _power(F.least("halvings", F.lit(most)))
        entries = times * 2 * F.col("passed") + 4 * F.col("edges") + times * F.col("ends")
        return F.sum(entries * 48 + times * times * F.col("polygons") * 64 + 32)

    # a very jagged outline passes many small cells: halved fewer times it still fits
    sizes = found.agg(*[size(most) for most in range(1, FINEST + 1)]).first()
    fitting = [most for most, s in enumerate(sizes, 1) if s is not None and s <= broadcast_bytes]
    if not fitting:
        return None
    return found.select("number", F.least("halvings", F.lit(fitting[-1])).alias("halvings"))


def halved_tests(tests: DataFrame, crowded: DataFrame, grid: Grid) -> DataFrame:
    """``cell_tests`` with the crowded cells halved; ``halvings`` tells how often.

    In a small cell the edges of the crowded one are clipped again, those right of it
    flip it by their ends, and so do the ends that flipped the crowded cell.
    """
    number = grid.number(F.col("row"), F.col("cell"))
    known = F.broadcast(crowded.withColumnRenamed("number", "__number"))
    whole = tests.join(known, number == F.col("__number"), "left_anti").withColumn("halvings", F.lit(0))
    h, times = F.col("halvings"), _power(F.col("halvings")).cast("long")
    inner = tests.join(known, number == F.col("__number")).drop("__number")
    inner = inner.withColumns(
        {
            "first": F.col("cell") * times, "end": (F.col("cell") + 1) * times,
            "bottom": F.col("row") * times, "top": (F.col("row") + 1) * times - 1,
        }
    ).drop("row", "cell")
    keys = ["pid", "halvings", "first"]

    rows = F.sequence(
        F.greatest("bottom", grid.row(F.least("y1", "y2"), h)), F.least("top", grid.row(F.greatest("y1", "y2"), h))
    )
    pieces = _clipped(inner.where("kind = 'edge'").withColumn("row", F.explode(rows)), grid, h)
    pieces = pieces.where("c1 >= first").withColumns(
        {"c0": F.least(F.greatest("c0", "first"), F.col("end")), "c1": F.least("c1", F.col("end") - 1)}
    )
    near = pieces.where("c0 <= c1").select(
        "pid", "halvings", "row", F.explode(F.sequence("c0", "c1")).alias("cell"), "kind", "x1", "y1", "x2", "y2"
    )
    above = F.col("kind") == "above"
    to = F.when(above, F.col("top")).otherwise(grid.row(F.col("y1"), h))
    earlier = (
        inner.where("kind <> 'edge'")
        .withColumn("to", to)
        .withColumn("row", F.explode(F.sequence("bottom", "to")))
        .select(
            *keys, "row", F.col("end").alias("c0"),
            F.when(above | (F.col("row") < F.col("to")), F.lit(float("inf"))).otherwise(F.col("y1")).alias("y"),
        )
    )
    ends = _ends(pieces.where("c0 > first"), grid, keys, h).unionByName(earlier)
    return whole.unionByName(near).unionByName(_far(ends, keys, F.col("first")).drop("first"))


def cell_table(tests: DataFrame, grid: Grid) -> DataFrame:
    """``cell_tests`` or ``halved_tests`` with one row per cell and polygon."""
    edge = F.struct("x1", "y1", "x2", "y2")
    halvings = F.col("halvings") if "halvings" in tests.columns else 0
    number = grid.number(F.col("row"), F.col("cell"), halvings)
    return tests.groupBy("pid", number.alias("number")).agg(
        F.collect_list(F.when(F.col("kind") == "edge", edge)).alias("near"),
        F.collect_list(F.when(F.col("kind") == "start", F.col("y1"))).alias("starts"),
        (F.count(F.when(F.col("kind") == "above", 1)) % 2 == 1).alias("above"),
    )


def _inside(x: Column, y: Column) -> Column:
    near, starts = F.col("__near"), F.col("__starts")
    parts = lambda test: lambda e: test(x, y, e["x1"], e["y1"], e["x2"], e["y2"])
    simple = (F.size(near) == 0) & (F.size(starts) == 0)
    flips = F.size(F.filter(near, parts(crosses_right))) + F.size(F.filter(starts, lambda s: s > y))
    odd = (flips + F.col("__above").cast("int")) % 2 == 1
    return F.when(simple, F.col("__above")).otherwise(odd | F.exists(near, parts(on_segment)))


def _marked(cells: DataFrame) -> DataFrame:
    return cells.select([F.col(c).alias(f"__{c}") for c in cells.columns])


def _join_cells(points, polygons, x, y, polygon_id, broadcast_bytes, grid, how):
    """Points joined to the cells that hold them, or None without polygons."""
    sides = edges(polygons, polygon_id)
    px, py = named(x), named(y)
    if grid is None:
        grid = fit_grid(sides, broadcast_bytes)
        if grid is None:
            return None
        # pushed down to the reader where x and y are stored columns
        points = points.where(grid.covers(px, py))
    tests = cell_tests(sides, grid)
    if grid.small or points.isStreaming:
        many = grid.small and grid.outline > MANY_SIDES
        crowded = crowded_cells(tests, grid, broadcast_bytes) if many else None
        halvings = 0
        if crowded is not None:
            tests = halved_tests(tests, crowded, grid)
            marks = F.broadcast(crowded.toDF("__cell", "__halvings"))
            points = points.join(marks, grid.number_at(px, py) == F.col("__cell"), "left")
            halvings = F.coalesce("__halvings", F.lit(0))
        cells = _marked(cell_table(tests, grid))
        here = grid.number_at(px, py, halvings) == F.col("__number")
        found = points.join(F.broadcast(cells) if grid.small else cells, here & _inside(px, py), how)
        return found.drop("__cell", "__halvings")
    spots = _spots_inside(points.select(px.alias("__x"), py.alias("__y")), tests, grid)
    if how == "left_semi":
        spots = spots.select("__x", "__y").distinct()
    # equal spots were tested once; adaptive execution splits a crowded one here
    return points.join(spots, (px == F.col("__x")) & (py == F.col("__y")), how)


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    x: str = "x",
    y: str = "y",
    polygon_id: str = "polygon_id",
    broadcast_bytes: int = BROADCAST_BYTES,
    grid: Grid | None = None,
) -> DataFrame:
    """Points inside any polygon, boundary included, each once.

    Points and polygons must be in the same coordinate system. A caller that has
    fitted the grid already passes it, and filters the points by its own means.
    """
    found = _join_cells(points, polygons, x, y, polygon_id, broadcast_bytes, grid, "left_semi")
    return points.where(F.lit(False)) if found is None else found


def tag_points(
    points: DataFrame,
    polygons: DataFrame,
    x: str = "x",
    y: str = "y",
    polygon_id: str = "polygon_id",
    broadcast_bytes: int = BROADCAST_BYTES,
    grid: Grid | None = None,
) -> DataFrame:
    """Points with the id of each polygon that holds them."""
    kind = polygons.schema[polygon_id].dataType
    found = _join_cells(points, polygons, x, y, polygon_id, broadcast_bytes, grid, "inner")
    if found is None:
        return points.where(F.lit(False)).withColumn(polygon_id, F.lit(None).cast(kind))
    return found.select(*[named(c) for c in points.columns], F.col("__pid").alias(polygon_id))


def _spots_inside(spots: DataFrame, tests: DataFrame, grid: Grid, salts: int = 16) -> DataFrame:
    """``__x, __y, __pid`` for a boundary too large to copy to every executor.

    Distinct positions meet the single tests of their cell. Positions of a busy
    cell are dealt over ``salts`` tasks, which each get the cell's tests. The
    verdict is a count, summed before the shuffle.
    """
    px, py = F.col("__x"), F.col("__y")
    salt = F.pmod(F.xxhash64(px, py), F.lit(salts)).cast("int")
    place = spots.distinct().withColumn("salt", salt)
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    met = place.alias("p").join(
        tests.withColumn("salt", copies).alias("t"),
        (grid.number_at(px, py) == grid.number(F.col("row"), F.col("cell")))
        & (F.col("p.salt") == F.col("t.salt")),
    )
    side = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    flip = (
        F.when(F.col("kind") == "edge", crosses_right(px, py, *side))
        .when(F.col("kind") == "start", F.col("y1") > py)
        .otherwise(F.lit(True))
    )
    touching = (F.col("kind") == "edge") & on_segment(px, py, *side)
    verdict = met.groupBy(px, py, F.col("pid").alias("__pid")).agg(
        F.sum(F.coalesce(flip, F.lit(False)).cast("int")).alias("flips"),
        F.max(F.coalesce(touching, F.lit(False))).alias("touching"),
    )
    return verdict.where("flips % 2 = 1 or touching").select("__x", "__y", "__pid")


def degrees_box(grid: Grid, srid: int) -> tuple[float, float, float, float]:
    """Degrees that surely contain the grid, for a filter on raw coordinates."""
    box = (grid.x_min, grid.y_min, grid.x_max, grid.y_max)
    if srid == 4326:
        return box
    return PROJECTIONS[srid].lon_lat_envelope(*box)


# ------------------------------------------------------------------ convex hull


def convex_hull(points: DataFrame, group: str, x: str = "x", y: str = "y", salts: int = 32) -> DataFrame:
    """Corners of the convex hull of each group: ``group, corner, x, y``.

    Corners start at the leftmost lowest point and run counter-clockwise; points
    on a straight stretch are left out. Each task first thins its own points
    batch by batch, before any shuffle; what is left of a group is thinned again
    in ``salts`` shares, then once more. A hull of hulls is the hull, so every
    step is exact, and each step passes on corners only.
    """
    source = points.select(
        named(group).alias("g"), named(x).cast("double").alias("x"), named(y).cast("double").alias("y")
    ).where("x is not null and y is not null")
    plain = T.StructType(
        [source.schema["g"], T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
    )
    numbered = T.StructType([plain[0], T.StructField("corner", T.IntegerType()), *plain[1:]])
    thin, finish = _hull_steps()
    share = F.pmod(F.xxhash64("x", "y"), F.lit(salts))
    shares = source.mapInPandas(thin, plain).repartition(F.col("g"), share)
    corners = shares.mapInPandas(thin, plain).groupBy("g").applyInPandas(finish, numbered)
    return corners.withColumnsRenamed({"g": group, "x": x, "y": y})


def _hull_steps(held: int = 200_000):
    # closures, so workers need nothing but numpy and pandas installed
    def hull(xs, ys):
        import numpy as np

        # points strictly inside the polygon of extreme points are no corners
        if len(xs) > 64:
            angle = np.arange(16) * (np.pi / 8)
            reach = np.outer(np.cos(angle), xs) + np.outer(np.sin(angle), ys)
            top = reach.argmax(axis=1)
            ex, ey = xs[top], ys[top]
            span = max(np.ptp(xs), np.ptp(ys), 1e-300)
            inner = np.ones(len(xs), dtype=bool)
            for i in range(16):
                j = (i + 1) % 16
                dx, dy = ex[j] - ex[i], ey[j] - ey[i]
                if dx or dy:
                    inner &= dx * (ys - ey[i]) - dy * (xs - ex[i]) > 1e-9 * span * span
            xs, ys = xs[~inner], ys[~inner]
        pts = sorted(set(zip(xs.tolist(), ys.tolist())))
        if len(pts) < 3:
            return pts

        def chain(seq):
            out = []
            for p in seq:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (
                    out[-1][1] - out[-2][1]
                ) * (p[0] - out[-2][0]):
                    out.pop()
                out.append(p)
            return out

        return chain(pts)[:-1] + chain(pts[::-1])[:-1]

    def frame(g, pts):
        import pandas as pd

        return pd.DataFrame({"g": [g] * len(pts), "x": [p[0] for p in pts], "y": [p[1] for p in pts]})

    def thinned(pdf):
        import pandas as pd

        parts = [
            frame(part["g"].iloc[0], hull(part["x"].to_numpy(), part["y"].to_numpy()))
            for _, part in pdf.groupby("g", dropna=False)
        ]
        return pd.concat(parts) if parts else pdf

    def thin(batches):
        import pandas as pd

        waiting, rows, corners = [], 0, 0
        for pdf in batches:
            waiting.append(pdf)
            rows += len(pdf)
            if rows < 2 * corners:  # thin again when the rows have doubled
                continue
            kept = thinned(pd.concat(waiting))
            waiting, rows, corners = [kept], len(kept), len(kept)
            if corners > held:  # pass on early rather than hold very many corners
                yield kept
                waiting, rows, corners = [], 0, 0
        if waiting:
            yield thinned(pd.concat(waiting))

    def finish(pdf):
        out = thinned(pdf)
        out.insert(1, "corner", range(1, len(out) + 1))
        return out

    return thin, finish


def hull_ring(hull: DataFrame, group: str, x: str = "x", y: str = "y") -> DataFrame:
    """Hull corners as one closed ring per group."""
    corner = F.struct("corner", named(x).alias("x"), named(y).alias("y"))
    ring = F.transform(
        F.sort_array(F.collect_list(corner)), lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))
    )
    out = hull.groupBy(named(group)).agg(ring.alias("ring"))
    return out.select(
        named(group),
        F.lit("POLYGON").alias("geometry_type"),
        F.array(F.concat("ring", F.slice("ring", 1, 1))).alias("rings"),
    )
