import pytest
from pyspark.sql import types as T

from bioobs.plans.occurrence import clip_to_boundary, write_clipped
from bioobs.schemas import GEOMETRY_SCHEMA, OCCURRENCE_SCHEMA
from bioobs.sources.readers import scan_data_files
from bioobs.streaming.clip_stream import start_clip_stream

BOUNDARY = T.StructType([T.StructField("polygon_id", T.IntegerType()), *GEOMETRY_SCHEMA])


def boundary(spark):
    ring = [(1_000_000.0, 400_000.0), (1_500_000.0, 400_000.0), (1_500_000.0, 900_000.0), (1_000_000.0, 900_000.0)]
    return spark.createDataFrame([(1, "POLYGON", [ring], 3005)], BOUNDARY)


def records(spark, lon, n):
    rows = [("K", None, f"C{i % 3}", None, None, None, None, lon, 49.0 + i / 100) for i in range(n)]
    return spark.createDataFrame(rows, OCCURRENCE_SCHEMA).coalesce(1)


@pytest.mark.parametrize("limit", [64 * 2**20, 0], ids=["broadcast", "shuffled"])
def test_each_file_once(spark, tmp_path, limit):
    inbox, out, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))

    def run():
        query = start_clip_stream(spark, inbox, boundary(spark), out, progress, broadcast_bytes=limit)
        query.awaitTermination()
        return spark.read.parquet(out)

    records(spark, -124.0, 30).write.parquet(inbox)
    records(spark, 10.0, 20).write.mode("append").parquet(inbox)  # nothing inside
    (tmp_path / "in" / "zero.parquet").write_bytes(b"")
    assert run().count() == 30
    assert run().count() == 30  # nothing new
    records(spark, -123.5, 12).write.mode("append").parquet(inbox)
    streamed = run()
    assert streamed.count() == 42

    batch = clip_to_boundary(spark.read.schema(OCCURRENCE_SCHEMA).parquet(inbox), boundary(spark))
    table = str(tmp_path / "batch")
    write_clipped(batch, table)
    columns = sorted(batch.columns)
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()), key=str)
    assert rows(streamed) == rows(scan_data_files(spark, table)) == rows(batch)
    assert {r.phylum for r in streamed.collect()} == {"unknown"}


def test_rows_gather_by_folder(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), tmp_path / "out"
    records(spark, -124.0, 60).repartition(12).write.parquet(inbox)
    start_clip_stream(spark, inbox, boundary(spark), str(out), str(tmp_path / "progress")).awaitTermination()
    folders = [len(list(f.glob("*.parquet"))) for f in out.glob("kingdom=*/phylum=*/class=*")]
    assert folders == [1, 1, 1]
