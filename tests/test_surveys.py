"""Survey jobs on hand-made files, results worked out by hand."""

import datetime as dt
import math

import pytest

from bioobs.fixed_values import DATASETS, EXTRA_SPECIES
from bioobs.operators.taxonomy import species_with_ranks
from bioobs.plans.surveys import (
    long_census_observations,
    plot_census_observations,
    stream_survey_observations,
    wide_census_observations,
)
from bioobs.schemas import BACKBONE_SCHEMA, CANDIDATE_SCHEMA, OBSERVATION_SCHEMA
from bioobs.sources.readers import read_csv, read_kml


def placemark(name, geometry):
    return f"<Placemark><name>{name}</name>{geometry}</Placemark>"


def polygon_at(x, y, w=0.01):
    ring = " ".join(f"{a},{b},0" for a, b in [(x, y), (x, y + w), (x + w, y + w), (x + w, y), (x, y)])
    return f"<Polygon><outerBoundaryIs><LinearRing><coordinates>{ring}</coordinates></LinearRing></outerBoundaryIs></Polygon>"


def point_at(x, y):
    return f"<Point><coordinates>{x},{y},0</coordinates></Point>"


def kml(spark, path, *marks):
    path.write_text("<kml><Document>" + "".join(marks) + "</Document></kml>")
    return read_kml(spark, str(path))


def csv(spark, path, text, types=None, position=False):
    path.write_text(text)
    return read_csv(spark, str(path), types, position)


@pytest.fixture
def taxonomy(spark):
    backbone = spark.createDataFrame(
        [(1, None, "kingdom", "Animalia"), (2, 1, "phylum", "Chordata"), (3, 2, "class", "Aves"), (4, 3, "order", "Charadriiformes"),
         (5, 4, "family", "Laridae"), (6, 5, "genus", "Larus"), (7, 3, "order", "Passeriformes"), (8, 7, "family", "Turdidae"),
         (9, 8, "genus", "Turdus"), (10, 9, "species", "Turdus migratorius"), (20, 2, "class", "Amphibia"),
         (21, 20, "genus", "Dicamptodon"), (22, 21, "species", "Dicamptodon tenebrosus")],
        BACKBONE_SCHEMA,
    )
    candidates = spark.createDataFrame(
        [("Larus spp.", 1, 6), ("Turdus migratorius", 1, 10), ("Turdus migratorius", 2, 6), ("Dicamptodon tenebrosus", 1, 22)],
        CANDIDATE_SCHEMA,
    )
    return candidates, backbone


def test_wide_census(spark, tmp_path, taxonomy):
    census = csv(
        spark, tmp_path / "census.csv",
        "Season,Species,DT,MID,UB,Note\n"
        "Spring,AMRO,40,0,,n\nWinter,GULL,,80,8,n\nWinter,Total,100,100,100,n\nSummer,BT,4,4,4,n\nSummer,NA,4,4,4,n\nAutumn,XXXX,0,0,2,n\n",
        {"dt": "double", "mid": "double", "ub": "double"},
    ).drop("note")
    species = csv(
        spark, tmp_path / "species.csv",
        "No,Code,Scientific Name,Common Name\n1,AMRO,Turdus migratorius,American Robin\n2,GULL,Larus spp.,Gull\n3,GULL,Larus spp.,Gull copy\n4,QQQQ,nobody,Nobody\n",
        {"no": "int"},
    )
    sites = kml(
        spark, tmp_path / "sites.kml", placemark("Lancaster_DT", polygon_at(-123.1, 49.2)), placemark("Lancaster_MID", polygon_at(-123.2, 49.2)),
        placemark("Lancaster_UB", polygon_at(-123.3, 49.2)), placemark("Lancaster_ZZ", polygon_at(-123.4, 49.2)),
    )
    out = wide_census_observations(census, sites, species_with_ranks(species, *taxonomy))
    assert out.schema.names == OBSERVATION_SCHEMA.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in OBSERVATION_SCHEMA]
    got = sorted(out.collect(), key=lambda r: (r.month_obs, r.observation_value, r.vernacular or ""))
    # the duplicate code doubles the gull rows; zeros, blanks, Total, BT and the nameless row are gone
    assert [(r.month_obs, r.day_obs, r.vernacular, r.observation_value, r.observed_rank) for r in got] == [
        (1, 15, "Gull", 0.2, "genus"), (1, 15, "Gull copy", 0.2, "genus"), (1, 15, "Gull", 2.0, "genus"), (1, 15, "Gull copy", 2.0, "genus"),
        (5, 6, "American Robin", 1.0, "species"), (9, 23, None, 0.05, "genus"),
    ]
    robin = got[4]
    assert (robin.valid_scientific_name, robin["order"], robin.genus) == ("Turdus migratorius", "Passeriformes", "Turdus")
    assert robin.longitude == pytest.approx(-123.095) and robin.latitude == pytest.approx(49.205)
    # a hundredth of a degree each way: about 1112 m by 729 m
    assert robin.coordinate_uncertainty == pytest.approx(math.sqrt(1112.1 * 729.0 / math.pi) + 10, rel=1e-3)
    assert (robin.year_obs, robin.observation_type, robin.group, robin.license) == (1974, "density_ha", "Aves", "CC0 1.0")
    assert robin.dataset_doi == DATASETS["birds_1974"]["dataset_doi"] and robin.effort_sampling_value is None


def test_long_census(spark, tmp_path, taxonomy):
    census = csv(
        spark, tmp_path / "census.csv",
        "Point Number,Date,Time Start,Time End,Species,Abundance 97,Abundance 98\n"
        "12a,,,,AMRO,5,1\n"  # before any date
        "12a,1996-05-20,8:00,8:05,AMRO,2,0\n12a,,,,RCKI OR GCKI?,.,3\nedge pt,,,,AMRO,9,9\n"
        "7b,1996-02-29,,,GULL,1,4\n7b,,,,NA,2,NA\n44a,1996-06-01,,,AMRO,1,1\n9z,,,,AMRO,1,1\n",
        {"date": "date", "abundance_98": "double"}, position=True,
    )
    species = csv(spark, tmp_path / "names.csv", "4 Letter Code,Scientific Name,Common Name\nAMRO,Turdus migratorius,American Robin\n")
    species = species.withColumnRenamed("x4_letter_code", "code")
    extra = spark.createDataFrame(EXTRA_SPECIES, species.schema)
    sites = kml(
        spark, tmp_path / "sites.kml", placemark("a12", point_at(-123.1, 49.1)), placemark("b7", point_at(-123.2, 49.2)),
        placemark("a44a", point_at(-123.3, 49.3)), placemark("z9 omit", point_at(-123.4, 49.4)), placemark("c1", point_at(-123.5, 49.5)),
    )
    out = long_census_observations(census, sites, species_with_ranks(species, *taxonomy, extra))
    assert out.schema.names == OBSERVATION_SCHEMA.names
    got = sorted(((r.year_obs, r.month_obs, r.day_obs, r.longitude, r.observation_value, r.vernacular, r.observed_rank) for r in out.collect()), key=str)
    assert got == sorted([
        (None, None, None, -123.1, 5.0, "American Robin", "species"), (None, None, None, -123.1, 1.0, "American Robin", "species"),
        (1997, 5, 20, -123.1, 2.0, "American Robin", "species"), (1998, 5, 20, -123.1, 3.0, None, "genus"),
        (None, None, None, -123.2, 1.0, "Gull", "genus"), (None, None, None, -123.2, 4.0, "Gull", "genus"),
        (None, None, None, -123.2, 2.0, None, "genus"),
    ], key=str)
    assert {r.coordinate_uncertainty for r in out.collect()} == {10.0}


def test_plot_census(spark, tmp_path, taxonomy):
    census = csv(
        spark, tmp_path / "census.csv", "Plot,Species,Abundance,Date\n19th_Yukon,AMRO,3,1967-06-01\nF_21st,AMRO,0,1967-06-01\nS_24th,AMRO,1,1967-06-02\nRockcliffe,AMRO,8,1967-06-03\n",
        {"abundance": "double", "date": "date"},
    )
    species = spark.createDataFrame([("AMRO", "Turdus migratorius", "American Robin")], "code string, scientific_name string, common_name string")
    sites = kml(spark, tmp_path / "sites.kml", *[placemark(f"weber{i}", point_at(-123 - i / 10, 49)) for i in range(1, 8)])
    out = plot_census_observations(census, sites, species_with_ranks(species, *taxonomy)).collect()
    assert sorted((r.longitude, r.observation_value, r.day_obs) for r in out) == [(-123.6, 1.0, 2), (-123.1, 3.0, 1)]
    assert {r.dataset_doi for r in out} == {"10.5683/SP2/K5LMLA"}


def words(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "ord int, text string").select("text", "ord")


def test_stream_survey(spark, tmp_path, taxonomy):
    survey = csv(
        spark, tmp_path / "rows.csv", "date,Stream,location m\n1994-07-01,Nes19,.\n1995-07-02,Nes19,minus 5\n1996-07-03,Foo,12.5\n1997-07-04,Foo,sand\n1998-07-05,Lost,NA\n",
        {"date": "date"},
    ).withColumnRenamed("stream", "Stream")
    page = words(spark, "Site", "Nes19d", "600000E,", "5430000N", "Foo", "500000E,", "5427455.781N", "the", "end")
    out = stream_survey_observations(survey, page, *taxonomy)
    assert out.schema.names == OBSERVATION_SCHEMA.names
    got = {r.year_obs: r for r in out.collect()}
    assert [got[y].coordinate_uncertainty for y in range(1994, 1999)] == [10.0, 5.0, 22.5, 22.5, 22.5]
    assert got[1996].longitude == pytest.approx(-123.0, abs=1e-9) and got[1996].latitude == pytest.approx(49.0, abs=1e-8)
    assert got[1994].longitude > -122 and got[1998].longitude is None
    r = got[1995]
    assert (r.valid_scientific_name, r.genus, r.observed_rank, r.observation_value, r.vernacular, r.license) == (
        "Dicamptodon tenebrosus", "Dicamptodon", "species", 1.0, "Coastal Giant Salamander", "CC-BY-4.0")


def test_stream_words_must_line_up(spark, taxonomy):
    survey = spark.createDataFrame([(dt.date(1994, 7, 1), "Nes19", "1")], "date date, Stream string, location_m string")
    page = words(spark, "Nes19", "600000E,", "600001E,", "5430000N")
    with pytest.raises(Exception, match="different length"):
        stream_survey_observations(survey, page, *taxonomy).collect()


def test_a_site_listed_twice_fails_the_job(spark, tmp_path, taxonomy):
    census = spark.createDataFrame([("p1", "AMRO", 2.0, dt.date(2000, 5, 6))], "plot string, species string, abundance double, date date")
    species = spark.createDataFrame([("AMRO", "Turdus migratorius", "Robin"), ("AMRO", "Larus spp.", "Gull")], "code string, scientific_name string, common_name string")
    ranked = species_with_ranks(species, *taxonomy)
    sites = kml(spark, tmp_path / "s.kml", *[placemark(n, polygon_at(x, 49.2)) for n, x in (("A", -123.1), ("A", -123.2), ("other", -123.3), ("third", -123.4))])
    with pytest.raises(Exception, match="duplicate key"):
        plot_census_observations(census, sites, ranked, plots={"A": "p1"}).collect()
    assert plot_census_observations(census, sites, ranked, plots={"A": "p1"}, unique_sites=False).count() == 4
    once = sites.where("name != 'A'")  # a name without a plot is no repeated site
    assert plot_census_observations(census, once, ranked, plots={"other": "p1"}).count() == 2
    with pytest.raises(Exception, match="duplicate key"):
        plot_census_observations(census, once, ranked, plots={"other": "p1"}, unique_species=True).collect()
