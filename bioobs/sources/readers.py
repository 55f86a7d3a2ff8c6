"""Reading survey files, occurrence tables and site files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bioobs.functions.rings import oriented, point
from bioobs.functions.text import clean_names
from bioobs.functions.values import as_numeric
from bioobs.operators.ordering import BLOCK, FILE, POSITION, with_file_position
from bioobs.operators.shape import named
from bioobs.sources.csv_records import csv_records, parsed_records
from bioobs.sources.csv_types import as_inferred, infer_types


def scan_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet files as one lazy table.

    With a schema no footer is read while planning, and empty files are skipped.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def scan_data_files(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Only the ``*.parquet`` files under a folder that also holds markers.

    Folder names become partition columns, as text unless ``schema`` types them: a
    taxon called ``007`` keeps its zeros whatever the session's setting.
    """
    files = lambda: spark.read.option("pathGlobFilter", "*.parquet").option("basePath", path)
    if schema is None:
        schema = files().option("recursiveFileLookup", True).parquet(path).schema
    found = files().schema(schema).parquet(path).schema
    stored = set(schema.names)
    typed = [f if f.name in stored else T.StructField(f.name, T.StringType()) for f in found]
    return files().schema(T.StructType(typed)).parquet(path)


_CSV = {"escape": '"', "nullValue": "NA", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
_BAD = "__bad_line"


def _csv_rows(spark: SparkSession, path: str, position: bool, multi_line: bool) -> DataFrame:
    """All fields as text, the place if asked, and in ``__bad_line`` what has too few or too many fields."""
    reader = spark.read.options(**_CSV).option("header", True).option("enforceSchema", False)
    names = reader.option("multiLine", multi_line).csv(path).columns
    if not multi_line:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _BAD]])
        rows = reader.option("multiLine", False).option("columnPruning", False).option("columnNameOfCorruptRecord", _BAD).schema(schema).csv(path)
        rows = with_file_position(rows) if position else rows
    else:
        records = csv_records(spark, path)
        rows = parsed_records(records, names, _BAD, _CSV)
        first = (F.col(BLOCK) == 0) & (F.col(POSITION) == 0)
        header = F.lit(True)
        for c in names:  # Spark numbers repeated and empty names, which no file can be held against
            header &= F.coalesce(named(c), F.lit("")).eqNullSafe(F.lit(c)) if names.count(c) == 1 and not c.startswith("_c") else F.lit(True)
        other = F.raise_error(F.concat(F.lit("another header in "), F.col(FILE))).cast("boolean")
        rows = rows.where(F.when(~first, F.lit(True)).when(header, F.lit(False)).otherwise(other))
        rows = rows if position else rows.drop(FILE, BLOCK, POSITION)
    return rows.withColumnsRenamed(dict(zip(names, clean_names(names))))


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    position: bool = False,
    multi_line: bool = False,
    infer: bool = False,
    bad_lines: str = "raise",
) -> DataFrame:
    """CSV with a header: cleaned names, ``NA`` and blanks missing, bad values NULL.

    Several files must have the same header, which is checked. ``types`` maps cleaned
    names to Spark types; of the others, ``infer`` finds the types by one pass over all
    values, or they stay text. ``position`` adds the order columns ``fill_down`` needs.
    Quotes inside a quoted field are doubled. ``multi_line`` allows line breaks inside
    quotes; every file is still read by as many tasks as it has splits.

    A line with too few or too many fields fails the query, or is left out by
    ``bad_lines="drop"``; ``csv_rejects`` lists such lines.
    """
    if bad_lines not in ("raise", "drop"):
        raise ValueError("bad_lines is 'raise' or 'drop'")
    rows = _csv_rows(spark, path, position, multi_line)
    # Spark refuses to read bad lines without any other field, as a count would
    field = F.coalesce(named(rows.columns[0]), F.lit(""))
    told = F.concat(F.lit("a line has too few or too many fields: "), F.substring(named(_BAD), 1, 200), F.substring(field, 1, 0))
    wrong = F.length(field) < 0 if bad_lines == "drop" else F.raise_error(told).cast("boolean")
    df = rows.where(F.when(named(_BAD).isNull(), F.lit(True)).otherwise(wrong)).drop(_BAD)
    types = types or {}
    casts = {c: as_numeric(named(c)) if t == "double" else named(c).try_cast(t) for c, t in types.items()}
    if infer:
        rest = [c for c in df.columns if c not in types and c not in (FILE, BLOCK, POSITION)]
        casts |= {c: as_inferred(named(c), kind) for c, kind in infer_types(df, rest).items()}
    return df.withColumns(casts) if casts else df


def csv_rejects(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``_file, _block, _position, record`` of lines with too few or too many fields."""
    rows = _csv_rows(spark, path, True, multi_line).where(named(_BAD).isNotNull())
    nothing = F.substring(F.coalesce(named(rows.columns[0]), F.lit("")), 1, 0)
    return rows.select(FILE, BLOCK, POSITION, F.concat(named(_BAD), nothing).alias("record"))


_RING = T.StructType([T.StructField("LinearRing", T.StructType([T.StructField("coordinates", T.StringType())]))])
_POLYGON = T.StructType(
    [T.StructField("outerBoundaryIs", _RING), T.StructField("innerBoundaryIs", T.ArrayType(_RING))]
)
_POINT = T.StructType([T.StructField("coordinates", T.StringType())])
PLACEMARK = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("Point", _POINT),
        T.StructField("Polygon", _POLYGON),
        T.StructField("MultiGeometry", T.StructType([T.StructField("Polygon", T.ArrayType(_POLYGON))])),
    ]
)


def _vertices(text):
    tuples = F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda t: t != "")
    return F.transform(
        tuples,
        lambda t: point(F.split(t, ",")[0].cast("double"), F.split(t, ",")[1].cast("double")),
    )


def _polygon_rings(polygon):
    outer = oriented(_vertices(polygon["outerBoundaryIs"]["LinearRing"]["coordinates"]), hole=False)
    holes = F.transform(
        F.coalesce(polygon["innerBoundaryIs"], F.array().cast(T.ArrayType(_RING))),
        lambda h: oriented(_vertices(h["LinearRing"]["coordinates"]), hole=True),
    )
    return F.concat(F.array(outer), holes)


def read_kml(spark: SparkSession, path: str) -> DataFrame:
    """Placemarks as ``name, geometry_type, rings, srid``; KML is always WGS84.

    A point is one ring with one vertex.
    """
    marks = spark.read.format("xml").option("rowTag", "Placemark").schema(PLACEMARK).load(path)
    point_at = F.col("Point.coordinates")
    many = F.col("MultiGeometry.Polygon")
    kind = F.when(point_at.isNotNull(), "POINT").when(many.isNotNull(), "MULTIPOLYGON").when(
        F.col("Polygon").isNotNull(), "POLYGON"
    )
    rings = (
        F.when(point_at.isNotNull(), F.array(_vertices(point_at)))
        .when(many.isNotNull(), F.flatten(F.transform(many, _polygon_rings)))
        .when(F.col("Polygon").isNotNull(), _polygon_rings(F.col("Polygon")))
    )
    return marks.select(
        "name", kind.alias("geometry_type"), rings.alias("rings"), F.lit(4326).alias("srid")
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, size, modified`` of all non-empty files below a folder.

    Contents are not read. Spark plans no work for a file of zero bytes, so such
    files are absent, which is what a scan wants.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )


def literal_table(spark: SparkSession, schema: str | T.StructType, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
