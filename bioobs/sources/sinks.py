"""Writing parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from bioobs.operators.shape import named

# fixed value: rows per file of a partitioned data set
ROWS_PER_FILE = 50_000


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "errorifexists",
) -> None:
    """One folder per value combination, files of at most ``rows_per_file`` rows.

    Rebalancing gathers each folder's rows in few tasks, and splits a folder
    that is too large for one task (most records may be of one class) while the
    job runs.
    """
    spread = df.hint("rebalance", *[named(c) for c in by])
    writer = spread.write.partitionBy(*by).option("maxRecordsPerFile", rows_per_file)
    writer.mode(mode).parquet(path)
