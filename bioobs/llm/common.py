"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bioobs.session import shared_folder

# fixed value: what separates words, in every contract of this folder
WORD = r"[^\x20\x09-\x0D]+"
# Spark's setting: remove a query's shuffle files when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the table to the shared folder and read it back.

    This cuts the lineage, so that a lost executor costs no more than the tasks
    it was running, and a table used twice is computed once. The shuffle files
    behind it go as soon as it is written, not when the driver next collects its
    garbage: nothing reads them any more.
    """
    path = shared_folder(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 if it is missing."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_rows(df: DataFrame, columns: list[str], row: Callable, schema: str, chunk: int = 512) -> DataFrame:
    """Apply ``row(*values) -> tuple`` to each row inside Arrow batches.

    Values are turned into Python objects ``chunk`` rows at a time, so memory
    follows the longest texts, not the batch size.
    """
    return df.select(*columns).mapInArrow(_Rows(row, schema, chunk), schema)


class _Rows:
    def __init__(self, row: Callable, schema: str, chunk: int):
        self.row, self.schema, self.chunk = row, schema, chunk

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(self.schema)
        for batch in batches:
            for at in range(0, batch.num_rows, self.chunk):
                part = batch.slice(at, self.chunk)
                rows = [self.row(*v) for v in zip(*(c.to_pylist() for c in part.columns))]
                yield batch_of(rows, out)


# fixed values: Arrow types of the column types that the schemas here use
ARROW_TYPES = {
    "string": pa.string(),
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
}


def arrow_schema(schema: str) -> pa.Schema:
    """``"a long, b string"`` as an Arrow schema."""
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in (f.split() for f in schema.split(","))])


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )
