"""Decide whether an earlier download already answers a request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bioobs.fixed_values import REUSE_DAYS
from bioobs.functions.rings import polygon_wkt
from bioobs.operators.predicates import DEFAULT_QUALITY, And, Predicate, Within, predicate_table
from bioobs.operators.requests import (
    flat_predicates,
    matching_requests,
    newest_match,
    usable_history,
)
from bioobs.plans.occurrence import request_region


def request_for(wkt: str) -> Predicate:
    """Records of good quality within a region."""
    return And(Within(wkt), *DEFAULT_QUALITY.parts)


def request_for_boundary(boundary: DataFrame, source: int = 3005) -> Predicate:
    """A request for the convex hull of a boundary, in degrees.

    The text of the region is part of the request, so its corners come to the driver.
    """
    region = request_region(boundary, source).select(polygon_wkt("rings")).first()
    if region is None:
        raise ValueError("the boundary has no polygon")
    return request_for(region[0])


def reusable_download(
    spark: SparkSession,
    history: DataFrame,
    request: Predicate,
    as_of,
    days: int = REUSE_DAYS,
    mode: str = "exact",
) -> DataFrame:
    """The newest recent download of the same request: one row or none.

    Values and regions are compared as text.
    """
    recent = usable_history(history, as_of, days)
    rows = flat_predicates(recent)
    names = ["type", "key", "value", "geometry"]
    current = predicate_table(spark, request).select(names)
    defaults = predicate_table(spark, DEFAULT_QUALITY).select(names)
    # a request without predicates has no row, but in subset mode it matches
    bare = recent.where("coalesce(size(predicates), 0) <= 0").select("key")
    matched = matching_requests(rows, defaults, current, "request", mode)
    if mode == "subset":
        matched = matched.union(bare)
    return newest_match(recent, matched)
