"""Has this request been made before? Answered with joins over the history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from bioobs import fixed_values as V
from bioobs.functions.values import newer_than
from bioobs.operators.joins import natural_join
from bioobs.operators.shape import named


def usable_history(
    history: DataFrame,
    as_of: date | str,
    days: int = V.REUSE_DAYS,
    status: str = V.REQUEST_STATUS,
    source: str = V.REQUEST_SOURCE,
) -> DataFrame:
    """Finished requests of one client within the reuse window."""
    return history.where(
        (F.col("status") == status) & (F.col("source") == source) & newer_than("created", as_of, days)
    )


def flat_predicates(history: DataFrame) -> DataFrame:
    """Request history to ``(request, type, key, value, geometry)`` rows.

    A predicate without values keeps one row with a NULL value, and so does one
    whose values are all missing.
    """
    one = history.select(F.col("key").alias("request"), F.inline("predicates"))
    values = F.filter(F.coalesce("values", F.array().cast("array<string>")), lambda v: v.isNotNull())
    filled = F.when(F.size(values) > 0, values)
    return one.select("request", "type", "key", F.explode_outer(filled).alias("value"), "geometry")


def matching_requests(
    requests: DataFrame,
    defaults: DataFrame,
    current: DataFrame,
    key: str = "request",
    mode: str = "exact",
) -> DataFrame:
    """Keys of past requests that ask for the same as ``current``.

    All three are predicate rows; default predicates are ignored on both sides.
    ``exact`` wants the same set, ``subset`` only that all of the past request's
    own predicates occur in the current one (so a request without any matches).
    Every step is set-based: counting happens before the shuffle by request, so
    a request with very many predicates is no hot spot.
    """
    if mode not in ("exact", "subset"):
        raise ValueError("mode is 'exact' or 'subset'")
    wanted = natural_join(current.distinct(), defaults, "left_anti")
    everyone = requests.select(named(key)).distinct()
    own = natural_join(requests.distinct(), defaults, "left_anti")
    found = natural_join(own, wanted.withColumn("__hit", F.lit(1)), "left")
    counted = found.groupBy(named(key)).agg(
        F.count("*").alias("__own"), F.count("__hit").alias("__both")
    )
    judged = everyone.join(counted, key, "left").fillna(0, ["__own", "__both"])
    same = F.col("__own") == F.col("__both")
    if mode == "exact":
        same = same & (F.col("__both") == wanted.agg(F.count("*")).scalar())
    return judged.where(same).select(named(key))


def newest_match(history: DataFrame, matched: DataFrame, key: str = "key") -> DataFrame:
    """The most recent matching request, or nothing."""
    hits = history.join(matched.select(F.col(matched.columns[0]).alias("__k")), named(key) == F.col("__k"), "left_semi")
    return hits.orderBy(F.col("created").desc(), named(key)).limit(1)


def needs_request(match: DataFrame) -> bool:
    """True if no usable answer exists."""
    return match.isEmpty()


def not_yet_processed(inputs: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """Input files that a manifest of finished ones does not list."""
    return inputs.join(done.select(named(path)), path, "left_anti")


