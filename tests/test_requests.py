import datetime as dt

import pytest

from bioobs.operators.predicates import And, DEFAULT_QUALITY, Equals, In, Not, Within, predicate_table
from bioobs.operators.requests import flat_predicates, needs_request
from bioobs.plans.download_requests import request_for, reusable_download
from bioobs.schemas import REQUEST_HISTORY_SCHEMA

WKT = "POLYGON ((-139 48, -114 48, -114 60, -139 60, -139 48))"
DEFAULTS = [
    ("equals", "HAS_GEOSPATIAL_ISSUE", ["false"], None, False),
    ("equals", "HAS_COORDINATE", ["true"], None, False),
    ("equals", "OCCURRENCE_STATUS", ["PRESENT"], None, False),
    ("not in", "BASIS_OF_RECORD", ["LIVING_SPECIMEN", "FOSSIL_SPECIMEN", None], None, False),
]
HERE = ("within", None, [], WKT, None)
EXTRA = ("equals", "TAXON_KEY", ["212"], None, None)


def history(spark):
    day = lambda d: dt.datetime(2024, 5, d, 12)
    rows = [
        ("exact-old", "d1", "SUCCEEDED", "rgbif", day(10), DEFAULTS + [HERE]),
        ("exact-new", "d2", "SUCCEEDED", "rgbif", day(12), [HERE] + DEFAULTS),
        ("no-default", "d3", "SUCCEEDED", "rgbif", day(11), [HERE]),
        ("bare", "d4", "SUCCEEDED", "rgbif", day(20), DEFAULTS),
        ("empty", "d5", "SUCCEEDED", "rgbif", day(21), []),
        ("more", "d6", "SUCCEEDED", "rgbif", day(25), DEFAULTS + [HERE, EXTRA]),
        ("failed", "d7", "CANCELLED", "rgbif", day(26), DEFAULTS + [HERE]),
        ("other-client", "d8", "SUCCEEDED", "web", day(26), DEFAULTS + [HERE]),
        ("stale", "d9", "SUCCEEDED", "rgbif", dt.datetime(2024, 4, 28, 23), DEFAULTS + [HERE]),
    ]
    return spark.createDataFrame(rows, REQUEST_HISTORY_SCHEMA)


def found(spark, request, mode="exact", as_of="2024-05-28"):
    return [r.key for r in reusable_download(spark, history(spark), request, as_of, mode=mode).collect()]


def test_newest_exact_request(spark):
    assert found(spark, request_for(WKT)) == ["exact-new"]


def test_other_region_needs_a_request(spark):
    other = reusable_download(spark, history(spark), request_for("POLYGON ((0 0, 1 0, 1 1, 0 0))"), "2024-05-28")
    assert needs_request(other)
    assert not needs_request(reusable_download(spark, history(spark), request_for(WKT), "2024-05-28"))


def test_window_of_thirty_days(spark):
    assert found(spark, request_for(WKT), as_of="2024-06-10") == ["exact-new"]
    assert found(spark, request_for(WKT), as_of="2024-06-11") == []


def test_subset_mode_accepts_fewer_predicates(spark):
    assert found(spark, request_for(WKT), "subset") == ["empty"]
    wider = And(Within(WKT), *DEFAULT_QUALITY.parts, Equals("TAXON_KEY", 212))
    assert found(spark, wider) == ["more"]


def test_flat_predicates_keep_valueless_ones(spark):
    flat = flat_predicates(history(spark)).where("request = 'exact-old'").collect()
    assert len(flat) == 6
    assert [r.value for r in flat if r.type == "within"] == [None]


def test_predicate_rows(spark):
    rows = predicate_table(spark, And(Equals("A", True), Not(In("B", ("x", "y"))))).collect()
    assert [tuple(r)[:3] for r in rows] == [("equals", "A", "true"), ("not in", "B", "x"), ("not in", "B", "y")]


def test_every_branch_of_the_quality_filter(spark):
    good = (1, -120.0, 50.0, False, True, "PRESENT", "HUMAN_OBSERVATION")
    rows = [good] + [
        (2, -150.0, 50.0) + good[3:], (3,) + good[1:3] + (True,) + good[4:], (4,) + good[1:4] + (False,) + good[5:],
        (5,) + good[1:5] + ("ABSENT", good[6]), (6,) + good[1:6] + ("FOSSIL_SPECIMEN",), (7,) + good[1:6] + ("LIVING_SPECIMEN",),
        (8,) + good[1:6] + (None,), (9, None, 50.0) + good[3:], (10, -139.0, 60.0) + good[3:],
    ]
    df = spark.createDataFrame(rows, "id int, lon double, lat double, has_geospatial_issue boolean, has_coordinate boolean, occurrence_status string, basis_of_record string")
    kept = df.where(request_for(WKT).to_column(longitude="lon", latitude="lat"))
    assert sorted(r.id for r in kept.collect()) == [1, 10]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        found(spark, request_for(WKT), "fuzzy")
