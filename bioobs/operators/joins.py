"""Joins in which a missing key equals a missing key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from bioobs.operators.shape import named

# A side may be copied to every executor up to these sizes, checked before use.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark for broadcast after checking the size; otherwise leave it to the planner.

    The check looks at no more than ``BROADCAST_ROWS + 1`` rows.
    """
    size = sum(
        (F.coalesce(F.octet_length(named(f.name)), F.lit(0)) if f.dataType.typeName() == "string" else F.lit(0)) + 16
        for f in df.schema
    )
    seen = (
        df.limit(BROADCAST_ROWS + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b"))
        .first()
    )
    return F.broadcast(df) if seen.n <= BROADCAST_ROWS and seen.b <= BROADCAST_BYTES else df


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]):
    return reduce(
        lambda a, b: a & b,
        [left[f"`{a}`"].eqNullSafe(right[f"`{b}`"]) for a, b in pairs],
    )


def join_named(
    left: DataFrame, right: DataFrame, by: Sequence[tuple[str, str]], how: str = "left"
) -> DataFrame:
    """Join on differently named keys. The right keys are not in the result.

    No side is forced to broadcast: Spark compares its size with
    ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed keys at run time.
    """
    marked = right.withColumnsRenamed({b: f"__{b}" for _, b in by})
    pairs = [(a, f"__{b}") for a, b in by]
    joined = left.join(marked, null_safe_on(left, marked, pairs), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__{b}" for _, b in by])


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on all columns the two tables share, each kept once."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return join_named(left, right, [(c, c) for c in shared], how)


def expect_unique(df: DataFrame, keys: Sequence[str], missing: bool = True) -> DataFrame:
    """The same rows in place, or the query fails when it runs if a key repeats.

    Only keys are counted; rows do not move. Missing keys equal each other, or with
    ``missing=False`` do not count.
    """
    counted = df if missing else df.dropna(subset=list(keys))
    repeated = counted.groupBy(*[named(k) for k in keys]).count().where("count > 1").agg(F.count("*")).scalar()
    message = F.lit(f"duplicate key in {list(keys)}")
    return df.where(F.when(repeated == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def recycle(df: DataFrame, single: DataFrame) -> DataFrame:
    """Attach a one-row table to every row.

    The row is a scalar subquery: computed once, no join. The query fails if the
    table has no row or several.
    """
    packed = single.agg(
        F.count("*").alias("__n"), F.first(F.struct(*[named(c) for c in single.columns])).alias("__r")
    )
    only = F.when(F.col("__n") == 1, F.col("__r")).otherwise(
        F.raise_error(F.lit("expected exactly one row"))
    )
    return df.withColumn("__r", packed.select(only.alias("__r")).scalar()).select(
        *[named(c) for c in df.columns], "__r.*"
    )


def impute_max(df: DataFrame, column: str) -> DataFrame:
    """Replace missing values by the largest value of the column.

    The maximum is a scalar subquery, not a window over the whole table, so rows
    stay where they are.
    """
    top = df.agg(F.max(named(column))).scalar()
    return df.withColumn(column, F.coalesce(named(column), top))
