"""Operations that need a row order, without sorting everything in one task.

Order is a pair: ``chunk`` columns that cut the table into bounded, ordered
pieces, and one ``order`` column inside a piece. What crosses pieces (a value
carried over, a count) is summarised to one row per piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bioobs.operators.shape import named

FILE, BLOCK, POSITION = "_file", "_block", "_position"
FILE_ORDER = {"chunk": [FILE, BLOCK], "order": POSITION}


def with_file_position(scan: DataFrame) -> DataFrame:
    """Order columns for a text-file scan; must sit directly on the scan.

    A chunk is one file split, so its size is bounded by
    ``spark.sql.files.maxPartitionBytes``.
    """
    return scan.withColumns(
        {
            FILE: F.col("_metadata.file_path"),
            BLOCK: F.col("_metadata.file_block_start"),
            POSITION: F.monotonically_increasing_id(),
        }
    )


def with_key_chunk(df: DataFrame, key: str, rows: int = 1_000_000) -> DataFrame:
    """A ``_block`` column from a unique integer key: at most ``rows`` rows per block."""
    return df.withColumn(BLOCK, F.floor(named(key) / rows))


def _summary_window(chunk: Sequence[str]) -> W:
    # one row per chunk, so the global order costs next to nothing
    return W.orderBy(*[named(c) for c in chunk]).rowsBetween(W.unboundedPreceding, -1)


def fill_down(df: DataFrame, columns: Sequence[str], chunk: Sequence[str], order: str) -> DataFrame:
    """Replace missing values by the last value above, across the whole table."""
    keys = [named(c) for c in chunk]
    tails = df.groupBy(*keys).agg(
        *[
            F.max_by(named(c), F.when(named(c).isNotNull(), named(order))).alias(f"__{c}")
            for c in columns
        ]
    )
    carried = tails.select(
        *[named(c).alias(f"__k{i}") for i, c in enumerate(chunk)],
        *[
            F.last(named(f"__{c}"), ignorenulls=True).over(_summary_window(chunk)).alias(f"__{c}")
            for c in columns
        ],
    )
    inside = W.partitionBy(*keys).orderBy(named(order)).rowsBetween(W.unboundedPreceding, 0)
    filled = df.withColumns({c: F.last(named(c), ignorenulls=True).over(inside) for c in columns})
    # rows are partitioned by chunk already, so this join moves only the summary
    on = [named(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(chunk)]
    joined = filled.join(carried, on, "left")
    return joined.withColumns(
        {c: F.coalesce(named(c), named(f"__{c}")) for c in columns}
    ).select([named(c) for c in df.columns])


def with_ordinal(
    df: DataFrame, into: str, chunk: Sequence[str], order: str, descending: bool = False
) -> DataFrame:
    """Row numbers 1, 2, 3 … over the whole table."""
    direction = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    keys = [named(c) for c in chunk]
    before = W.orderBy(*[direction(k) for k in keys]).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("__n"))
        .select(
            *[named(c).alias(f"__k{i}") for i, c in enumerate(chunk)],
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        )
    )
    inside = W.partitionBy(*keys).orderBy(direction(named(order)))
    numbered = df.withColumn("__rank", F.row_number().over(inside))
    on = [named(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(chunk)]
    return (
        numbered.join(offsets, on, "left")
        .withColumn(into, F.col("__before") + F.col("__rank"))
        .select([named(c) for c in df.columns if c != into] + [named(into)])
    )


def positional_zip(left: DataFrame, right: DataFrame, ordinal: str) -> DataFrame:
    """Row i beside row i. Fails when it runs if the lengths differ."""
    other = right.withColumnRenamed(ordinal, "__o")
    both = left.join(other, named(ordinal) == F.col("__o"), "full")
    checked = F.when(
        named(ordinal).isNotNull() & F.col("__o").isNotNull(), named(ordinal)
    ).otherwise(F.raise_error(F.lit("tables of different length")))
    return both.withColumn(ordinal, checked).drop("__o")


def first_per_group(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each group.

    Spark limits each group inside every task before the shuffle, so a group
    that holds much of the table does not travel to one task.
    """
    rank = F.row_number().over(W.partitionBy(*[named(k) for k in keys]).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def latest_snapshot(df: DataFrame, dates: DataFrame, column: str) -> DataFrame:
    """Rows of the newest snapshot named in ``dates``.

    The date is a scalar subquery, so a table partitioned by it reads one folder.
    """
    newest = dates.agg(F.max(named(column))).scalar()
    return df.where(named(column) == newest)
