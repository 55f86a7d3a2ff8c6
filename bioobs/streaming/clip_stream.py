"""Clip new occurrence files as they arrive, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from bioobs.operators.shape import named
from bioobs.plans.occurrence import PARTITION_RANKS, clip_to_boundary
from bioobs.schemas import OCCURRENCE_SCHEMA
from bioobs.sources.sinks import ROWS_PER_FILE


def start_clip_stream(
    spark: SparkSession,
    inbox: str,
    boundary: DataFrame,
    out: str,
    progress: str,
    schema: T.StructType = OCCURRENCE_SCHEMA,
    srid: int = 3005,
    by=PARTITION_RANKS,
    files_per_batch: int = 1000,
    **clip_options,
) -> StreamingQuery:
    """Process all files not seen before, then stop.

    ``progress`` is the stream's checkpoint folder and must be shared by all
    executors. It replaces markers for finished and empty files, and lets a
    killed run resume. The clip is a filter, so the stream holds no state. The
    records of a batch are gathered by folder before they are written, and a large
    folder is split again while the batch runs.
    """
    files = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", "*.parquet")
        .parquet(inbox)
    )
    clipped = clip_to_boundary(files, boundary, srid, **clip_options)
    gathered = clipped.hint("rebalance", *[named(c) for c in by])
    return (
        gathered.writeStream.format("parquet")
        .partitionBy(*by)
        .option("path", out)
        .option("checkpointLocation", progress)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .trigger(availableNow=True)
        .start()
    )
