"""Survey files to harmonised observations.

Each job joins small tables (sites, species) to the survey rows. Whatever a site
needs (area, centroid) is computed on the site table, before the rows multiply. A
site that is listed twice would multiply its observations, so it fails the job unless
``unique_sites`` is off; a repeated species code does with ``unique_species``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from bioobs import fixed_values as V
from bioobs.functions import text, values
from bioobs.functions.projection import reproject
from bioobs.functions.rings import area_m2, centroid, circle_radius
from bioobs.operators.joins import expect_unique, impute_max, natural_join, recycle
from bioobs.operators.matching import match_any
from bioobs.operators.ordering import (
    BLOCK,
    FILE_ORDER,
    fill_down,
    positional_zip,
    with_key_chunk,
    with_ordinal,
)
from bioobs.operators.shape import cols_between, conform, pivot_longer, starting_with, with_constants
from bioobs.operators.taxonomy import classify, observed_rank, ranks_wide
from bioobs.schemas import OBSERVATION_SCHEMA, RANKS

NO_EFFORT = {
    "effort_sampling_value": None,
    "effort_sampling_unit": None,
    "effort_sampling_method": None,
    "time_obs": None,
    "coordinate_uncertainty_unit": "meter",
}


def _located(sites: DataFrame) -> DataFrame:
    """Sites with centroid and area instead of geometry."""
    measured = sites.withColumns({"centre": centroid("rings"), "area": area_m2("rings")})
    return measured.withColumns(
        {"longitude": F.col("centre.x"), "latitude": F.col("centre.y")}
    ).drop("rings", "geometry_type", "srid", "centre")


def _once(df: DataFrame, keys: list[str], wanted: bool) -> DataFrame:
    return expect_unique(df, keys, missing=False) if wanted else df


def _finished(df: DataFrame, dataset: Mapping) -> DataFrame:
    """Names, provenance and the fixed column order."""
    named_cols = df.withColumn("observed_rank", observed_rank("species")).withColumnsRenamed(
        {"species": "valid_scientific_name", "common_name": "vernacular"}
    )
    return conform(
        with_constants(named_cols, {**NO_EFFORT, **dataset}, OBSERVATION_SCHEMA), OBSERVATION_SCHEMA
    )


def wide_census_observations(
    census: DataFrame,
    sites: DataFrame,
    species: DataFrame,
    dataset: Mapping = V.DATASETS["birds_1974"],
    site_columns: tuple[str, str] = ("dt", "ub"),
    year: int = 1974,
    calendar: Mapping[str, tuple[int, int]] = V.SEASON_CALENDAR,
    site_prefix: str = V.WIDE_CENSUS_SITE_PREFIX,
    skip=tuple(V.WIDE_CENSUS_SKIP),
    area_ha: float = V.CENSUS_AREA_HA,
    position_error: float = V.GPS_ERROR_M,
    unique_sites: bool = True,
    unique_species: bool = False,
) -> DataFrame:
    """A census with one column per site: densities per hectare at site centroids.

    ``species`` is the code list with ranks attached (``species_with_ranks``).
    """
    counted = census.where(~F.col("species").isin(*skip))
    long = pivot_longer(counted, cols_between(census, *site_columns), "site", "density")
    rows = long.withColumn("observation_value", F.col("density") / area_ha).drop("density")
    taxa = natural_join(rows.withColumnRenamed("species", "code"), _once(species.drop("no"), ["code"], unique_species))
    places = _located(sites).withColumn("site", F.lower(text.remove_first("name", site_prefix)))
    places = _once(places.drop("name"), ["site"], unique_sites)
    joined = natural_join(places, taxa).where("observation_value != 0")
    month = values.case_when(*[(F.col("season") == s, m) for s, (m, _) in calendar.items()])
    day = values.case_when(*[(F.col("season") == s, d) for s, (_, d) in calendar.items()])
    dated = joined.withColumns(
        {
            "coordinate_uncertainty": circle_radius("area") + position_error,
            "year_obs": F.lit(year),
            "month_obs": month,
            "day_obs": day,
        }
    )
    return _finished(dated, dataset)


def _count_observations(joined: DataFrame, dataset: Mapping, position_error: float) -> DataFrame:
    kept = joined.where("abundance != 0").withColumnRenamed("abundance", "observation_value")
    dated = kept.withColumns(
        {"coordinate_uncertainty": F.lit(position_error), **values.date_parts("date")}
    )
    return _finished(dated, dataset)


def split_site_code(column: str, letter_first: bool) -> dict:
    """A code like ``12a`` or ``a12`` as letter and number columns."""
    if letter_first:
        letter, number = text.sub_string(column, 1, 1), text.sub_string(column, 2, -1)
    else:
        letter, number = text.sub_string(column, -1, -1), text.sub_string(column, 1, -2)
    return {"site_letter": letter, "site_number": number}


def long_census(
    census: DataFrame,
    order: Mapping = FILE_ORDER,
    fixes: Mapping = V.SPECIES_CODE_FIXES,
    left_out_point: str = V.LEFT_OUT_POINT,
) -> DataFrame:
    """A census with gaps in its dates and one column of counts per year, as rows."""
    dated = fill_down(census, ["date"], order["chunk"], order["order"])
    counts = starting_with(dated, "abundance")
    # a lone dot stands for a missing count
    clean = dated.withColumns(
        {c: values.as_numeric(F.nullif(F.col(c).cast("string"), F.lit("."))) for c in counts}
    ).drop(*order["chunk"], order["order"])
    long = pivot_longer(clean, counts, "year", "abundance", "abundance_")
    return (
        long.withColumn("date", values.rebase_year("date", values.as_numeric("year") + 1900))
        .drop("year")
        .where(F.col("point_number") != left_out_point)
        .withColumns(split_site_code("point_number", letter_first=False))
        .withColumn("species", values.replace_values("species", fixes))
    )


def long_census_observations(
    census: DataFrame,
    sites: DataFrame,
    species: DataFrame,
    dataset: Mapping = V.DATASETS["birds_2000"],
    order: Mapping = FILE_ORDER,
    fixes: Mapping = V.SPECIES_CODE_FIXES,
    position_error: float = V.GPS_ERROR_M,
    left_out_point: str = V.LEFT_OUT_POINT,
    left_out_names: str = V.LEFT_OUT_NAMES,
    left_out_number: str = V.LEFT_OUT_NUMBER,
    unique_sites: bool = True,
    unique_species: bool = False,
) -> DataFrame:
    """Counts at point sites named by letter and number."""
    taxa = natural_join(long_census(census, order, fixes, left_out_point).withColumnRenamed("species", "code"), _once(species, ["code"], unique_species))
    places = (
        _located(sites.where(text.detect("name", left_out_names, negate=True)))
        .withColumns(split_site_code("name", letter_first=True))
        .where(F.col("site_number") != left_out_number)
        .drop("name")
    )
    places = _once(places, ["site_letter", "site_number"], unique_sites)
    return _count_observations(natural_join(places, taxa), dataset, position_error)


def plot_census_observations(
    census: DataFrame,
    sites: DataFrame,
    species: DataFrame,
    dataset: Mapping = V.DATASETS["birds_1967"],
    plots: Mapping = V.PLOT_NAMES,
    position_error: float = V.GPS_ERROR_M,
    unique_sites: bool = True,
    unique_species: bool = False,
) -> DataFrame:
    """Counts at plots whose names differ between census and site file."""
    taxa = natural_join(census.withColumnRenamed("species", "code"), _once(species, ["code"], unique_species))
    places = _located(sites).withColumn("plot", values.recode_values("name", plots)).drop("name")
    places = _once(places, ["plot"], unique_sites)
    return _count_observations(natural_join(places, taxa), dataset, position_error)


def stream_locations(
    words: DataFrame, survey: DataFrame, order: str = "ord", fixes: Mapping = V.STREAM_NAME_FIXES
) -> DataFrame:
    """Stream names and UTM positions that stand in separate runs of a word list.

    The i-th name, easting and northing belong together; the query fails if the
    three runs differ in length.
    """
    names = survey.select(F.col("Stream").alias("w")).where("w is not null").distinct()
    parts = {
        "Stream": match_any(words, "text", names, "w"),
        "easting": words.where(F.col("text").endswith("E,")),
        "northing": words.where(F.col("text").endswith("N")),
    }
    runs = []
    for name, part in parts.items():
        run = with_key_chunk(part.select(F.col("text").alias(name), F.col(order)), order)
        runs.append(with_ordinal(run, "i", [BLOCK], order).drop(BLOCK, order))
    table = positional_zip(positional_zip(runs[0], runs[1], "i"), runs[2], "i").drop("i")
    east = values.as_numeric(text.remove_first(text.remove_first("easting", ","), "E"))
    north = values.as_numeric(text.remove_first("northing", "N"))
    lon, lat = reproject("x", "y", 32610, 4326)
    return (
        table.select(
            values.replace_values("Stream", fixes).alias("Stream"), east.alias("x"), north.alias("y")
        )
        .withColumns({"longitude": lon, "latitude": lat})
        .drop("x", "y")
    )


def stream_survey_observations(
    survey: DataFrame,
    words: DataFrame,
    candidates: DataFrame,
    backbone: DataFrame,
    dataset: Mapping = V.DATASETS["salamanders"],
    fixes: Mapping = V.LOCATION_FIXES,
    stream_fixes: Mapping = V.STREAM_NAME_FIXES,
    position_error: float = V.GPS_ERROR_M,
) -> DataFrame:
    """One occurrence per survey row, placed at its stream."""
    located = natural_join(survey, stream_locations(words, survey, fixes=stream_fixes)).withColumn(
        "location_m", values.as_numeric(values.replace_values("location_m", fixes))
    )
    placed = impute_max(located, "location_m").withColumns(
        {
            "coordinate_uncertainty": F.col("location_m") + position_error,
            **values.date_parts("date"),
        }
    )
    name = dataset["valid_scientific_name"]
    taxon = ranks_wide(classify(candidates.where(F.col("query") == name), backbone))
    ranks = taxon.select([F.col(f"`{r}`") for r in RANKS if r != "species"])
    constants = {**NO_EFFORT, "observation_value": 1.0, "observed_rank": "species", **dataset}
    return conform(
        with_constants(recycle(placed, ranks), constants, OBSERVATION_SCHEMA), OBSERVATION_SCHEMA
    )
