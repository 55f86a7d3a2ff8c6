"""Names to classification ranks, by joining a backbone table.

``backbone`` is ``(taxon_id, parent_id, rank, name)``; ``candidates`` lists, for
each query name, the taxa it may mean, best first.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, functions as F

from bioobs.operators.joins import broadcast_if_small, join_named
from bioobs.operators.ordering import first_per_group
from bioobs.operators.shape import bind_rows, named, pivot_wider
from bioobs.schemas import RANKS
from bioobs.session import shared_folder


def best_candidates(candidates: DataFrame) -> DataFrame:
    return first_per_group(candidates, ["query"], F.col("candidate_rank"), F.col("taxon_id"))


def inner_taxa(backbone: DataFrame) -> DataFrame:
    """Taxa that are somebody's parent: the small upper part of the tree."""
    parents = backbone.where("parent_id is not null").select(F.col("parent_id").alias("__p")).distinct()
    return backbone.join(parents, F.col("taxon_id") == F.col("__p"), "left_semi")


def lineages(backbone: DataFrame) -> DataFrame:
    """``taxon_id, lineage, fault`` of the inner taxa: each one and all above it.

    Only the upper part of the tree is climbed, by doubling: after k rounds a
    lineage holds 2^k taxa, so a tree of any depth takes few rounds. Each round is
    a table in the shared folder. A parent that the backbone lacks, and a cycle,
    end the climb with a ``fault``.
    """
    spark, folder = backbone.sparkSession, shared_folder(backbone.sparkSession, "lineages")
    climbed = inner_taxa(backbone).select(
        "taxon_id",
        F.col("parent_id").alias("next"),
        F.array("taxon_id").alias("ids"),
        F.array(F.struct("rank", "name")).alias("lineage"),
        F.lit(None).cast("string").alias("fault"),
    )
    for turn in itertools.count():
        climbed.write.parquet(f"{folder}/{turn}")
        climbed = spark.read.parquet(f"{folder}/{turn}")
        if climbed.where("next is not null").isEmpty():
            return climbed.select("taxon_id", "lineage", "fault")
        upper = climbed.withColumnsRenamed({c: f"__{c}" for c in climbed.columns})
        text = F.col("next").cast("string")
        fault = (
            F.when(F.col("next").isNull(), F.col("fault"))
            .when(F.col("__taxon_id").isNull(), F.concat(F.lit("unknown parent taxon "), text))
            .when(F.array_contains("ids", F.col("next")), F.concat(F.lit("cycle at taxon "), text))
            .otherwise(F.col("__fault"))
        )
        longer = lambda c: F.when(F.col("__taxon_id").isNull(), F.col(c)).otherwise(F.concat(c, f"__{c}"))
        climbed = climbed.join(upper, F.col("next") == F.col("__taxon_id"), "left").select(
            "taxon_id",
            F.when(fault.isNull(), F.col("__next")).alias("next"),
            longer("ids").alias("ids"),
            longer("lineage").alias("lineage"),
            fault.alias("fault"),
        )


def classify(candidates: DataFrame, backbone: DataFrame) -> DataFrame:
    """Rows ``(query, rank, name)``: each query's taxon and all its ancestors.

    The tree is climbed before the queries are looked at; these then take one join.
    The query fails if one of its own taxa has an unknown parent or lies below a
    cycle. Faults elsewhere in the backbone do no harm.
    """
    above = broadcast_if_small(lineages(backbone).withColumnsRenamed({"taxon_id": "__up"}))
    unknown = F.concat(F.lit("unknown parent taxon "), F.col("parent_id").cast("string"))
    fault = F.when(F.col("__up").isNotNull(), F.col("fault")).otherwise(unknown)
    taxa = backbone.join(above, F.col("parent_id") == F.col("__up"), "left").select(
        "taxon_id",
        F.array(F.struct("rank", "name")).alias("own"),
        "lineage",
        F.when(F.col("parent_id").isNotNull(), fault).alias("fault"),
    )
    chain = F.when(F.col("lineage").isNull(), F.col("own")).otherwise(F.concat("own", "lineage"))
    sound = F.when(F.col("fault").isNull(), chain).otherwise(F.raise_error(F.col("fault")))
    found = best_candidates(candidates).select("query", "taxon_id").join(taxa, "taxon_id")
    return found.select("query", F.inline(sound))


def ranks_wide(classified: DataFrame) -> DataFrame:
    """One row per query, one column per rank."""
    return pivot_wider(classified, ["query"], "rank", "name", RANKS)


def species_with_ranks(
    species: DataFrame, candidates: DataFrame, backbone: DataFrame, extra: DataFrame | None = None
) -> DataFrame:
    """A species list with hand-made entries appended and ranks attached."""
    full = bind_rows(species, extra) if extra is not None else species
    wide = ranks_wide(classify(candidates, backbone))
    return join_named(full, wide, [("scientific_name", "query")])


def observed_rank(species: str = "species"):
    """``genus`` where the species name is missing."""
    return F.when(named(species).isNull(), "genus").otherwise("species")
