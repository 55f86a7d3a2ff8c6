"""Connected components of a table of links, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bioobs.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``links(a, b)``.

    Every round takes the smallest label among a node and its neighbours and then
    the label of that label, so paths shorten geometrically. Minima are taken within
    tasks before rows move, so a node with very many links is cheap. Each round is
    written to the shared folder. Repeated links and links to itself do no harm; rows
    with a missing end are ignored; no links give no rows.
    """
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = stored(
        known.select("a", "b").unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("near")), "b")
        lowest = labels.unionByName(seen.select(F.col("a").alias("node"), F.col("near").alias("component")))
        lowest = lowest.groupBy("node").agg(F.min("component").alias("low"))
        of_label = labels.select(F.col("node").alias("low"), F.col("component").alias("lower"))
        jumped = lowest.join(of_label, "low", "left").select("node", F.least("low", "lower").alias("component"))
        after = stored(jumped, "labels")
        changed = after.join(labels, ["node", "component"], "left_anti").limit(1).count()
        labels = after
        if not changed:
            return labels
