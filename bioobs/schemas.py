"""Column layouts shared by sources, jobs and tests."""

from __future__ import annotations

from pyspark.sql import types as T

RANKS = ["kingdom", "phylum", "class", "order", "family", "genus", "species"]

_STR, _DBL, _INT = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# The one output layout. Every survey job returns these columns in this order.
OBSERVATION_SCHEMA = _struct(
    ("dataset_name", _STR),
    ("dataset_creator", _STR),
    ("dataset_publisher", _STR),
    ("dataset_url_information", _STR),
    ("dataset_url_download", _STR),
    ("dataset_doi", _STR),
    ("license", _STR),
    ("valid_scientific_name", _STR),
    ("observation_value", _DBL),
    ("observation_type", _STR),
    ("effort_sampling_value", _DBL),
    ("effort_sampling_method", _STR),
    ("effort_sampling_unit", _STR),
    ("year_obs", _INT),
    ("month_obs", _INT),
    ("day_obs", _INT),
    ("time_obs", _STR),
    ("longitude", _DBL),
    ("latitude", _DBL),
    ("coordinate_uncertainty", _DBL),
    ("coordinate_uncertainty_unit", _STR),
    ("kingdom", _STR),
    ("phylum", _STR),
    ("class", _STR),
    ("order", _STR),
    ("family", _STR),
    ("genus", _STR),
    ("vernacular", _STR),
    ("group", _STR),
    ("observed_rank", _STR),
)

POINT = _struct(("x", _DBL), ("y", _DBL))
RINGS = T.ArrayType(T.ArrayType(POINT))

# A spatial table: rings of a polygon, outer rings counter-clockwise, holes clockwise.
GEOMETRY_SCHEMA = _struct(("geometry_type", _STR), ("rings", RINGS), ("srid", _INT))

BACKBONE_SCHEMA = _struct(
    ("taxon_id", T.LongType()), ("parent_id", T.LongType()), ("rank", _STR), ("name", _STR)
)
CANDIDATE_SCHEMA = _struct(("query", _STR), ("candidate_rank", _INT), ("taxon_id", T.LongType()))

OCCURRENCE_SCHEMA = T.StructType(
    [T.StructField(rank, _STR) for rank in RANKS]
    + [T.StructField("decimallongitude", _DBL), T.StructField("decimallatitude", _DBL)]
)

PREDICATE = T.StructType(
    [
        T.StructField("type", _STR),
        T.StructField("key", _STR),
        T.StructField("values", T.ArrayType(_STR)),
        T.StructField("geometry", _STR),
        T.StructField("match_case", T.BooleanType()),
    ]
)
REQUEST_HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("key", _STR),
        T.StructField("doi", _STR),
        T.StructField("status", _STR),
        T.StructField("source", _STR),
        T.StructField("created", T.TimestampType()),
        T.StructField("predicates", T.ArrayType(PREDICATE)),
    ]
)
