import csv
import io
import random

import pytest
from pyspark.sql import functions as F, types as T

from bioobs.functions.rings import planar_area
from bioobs.session import shared_folder
from bioobs.sources.csv_types import LATTICE, infer_types
from bioobs.sources.readers import csv_rejects, list_files, read_csv, read_kml, scan_data_files, scan_parquet
from bioobs.sources.sinks import write_partitioned, write_table

KML = """<?xml version="1.0" encoding="UTF-8"?>
<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder>
<Placemark><name>Lancaster_DT</name><Polygon><outerBoundaryIs><LinearRing><coordinates>
  -123.10,49.20,0 -123.10,49.30,0
  -123.00,49.30,0 -123.00,49.20,0 -123.10,49.20,0
</coordinates></LinearRing></outerBoundaryIs>
<innerBoundaryIs><LinearRing><coordinates>-123.06,49.24 -123.04,49.24 -123.04,49.26 -123.06,49.26 -123.06,49.24</coordinates></LinearRing></innerBoundaryIs>
</Polygon></Placemark>
<Placemark><name>a12</name><Point><coordinates>-123.5,49.5,0</coordinates></Point></Placemark>
<Placemark><name>two</name><MultiGeometry>
<Polygon><outerBoundaryIs><LinearRing><coordinates>0,0 1,0 1,1 0,1 0,0</coordinates></LinearRing></outerBoundaryIs></Polygon>
<Polygon><outerBoundaryIs><LinearRing><coordinates>5,5 5,6 6,6 6,5 5,5</coordinates></LinearRing></outerBoundaryIs></Polygon>
</MultiGeometry></Placemark>
</Folder></Document></kml>
"""


def test_kml(spark, tmp_path):
    (tmp_path / "sites.kml").write_text(KML)
    sites = {r["name"]: r for r in read_kml(spark, str(tmp_path / "sites.kml")).withColumn("area", planar_area("rings")).collect()}
    assert {k: r.geometry_type for k, r in sites.items()} == {"Lancaster_DT": "POLYGON", "a12": "POINT", "two": "MULTIPOLYGON"}
    assert sites["Lancaster_DT"].area == pytest.approx(0.01 - 0.0004)
    assert len(sites["Lancaster_DT"].rings) == 2 and sites["two"].area == pytest.approx(2.0)
    assert (sites["a12"].rings[0][0].x, sites["a12"].rings[0][0].y) == (-123.5, 49.5)
    assert {r.srid for r in sites.values()} == {4326}


def test_csv(spark, tmp_path):
    path = tmp_path / "birds.csv"
    path.write_text('4 letter code,Abundance 97,No\nAMRO,.,1\n"GULL, big",3,NA\n,NA,x\n')
    df = read_csv(spark, str(path), {"abundance_97": "double", "no": "int"})
    assert df.columns == ["x4_letter_code", "abundance_97", "no"]
    assert [tuple(r) for r in df.collect()] == [("AMRO", None, 1), ("GULL, big", 3.0, None), (None, None, None)]
    other = tmp_path / "other.csv"
    other.write_text("No,4 letter code,Abundance 97\n1,AMRO,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "*.csv")).collect()
    ordered = read_csv(spark, str(path), position=True)
    assert ordered.columns[:3] == df.columns and len(ordered.columns) == 6


def test_empty_files_are_skipped(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5).coalesce(1).write.parquet(folder)
    (tmp_path / "in" / "zero.parquet").write_bytes(b"")
    assert scan_parquet(spark, folder, T.StructType([T.StructField("id", T.LongType())])).count() == 5
    listed = list_files(spark, folder).where("path like '%.parquet'")
    assert listed.columns == ["path", "size", "modified"]
    assert [r.size > 0 for r in listed.collect()] == [True]


def test_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "hive")
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "1").otherwise("007").alias("class"))
    write_partitioned(df, path, ["class"], rows_per_file=100)
    (tmp_path / "hive" / "class=1" / "marker.txt").write_text("empty")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        back = scan_data_files(spark, path)
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    assert dict(back.dtypes)["class"] == "string" and back.count() == 1000
    assert {r["class"]: r["count"] for r in back.groupBy("class").count().collect()} == {"1": 100, "007": 900}
    sizes = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes <= 100
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_partitioned(df, path, ["class"])


def test_write_table_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_csv_quotes(spark, tmp_path):
    (tmp_path / "q.csv").write_text('Name,V\n"a ""b"", c",1\n"two\nlines",2\n')
    got = read_csv(spark, str(tmp_path / "q.csv"), {"v": "int"}, multi_line=True).collect()
    assert [tuple(r) for r in got] == [('a "b", c', 1), ("two\nlines", 2)]


@pytest.mark.parametrize("values, kind", [
    (["T", "false", None], "logical"), (["1", "-20", "0"], "integer"), (["1", "2.5", ".5", "5.", "1e-3", "Inf", "NaN"], "double"),
    (["123456789012345678901"], "double"), (["007", "1"], "text"), (["00.5"], "text"), (["."], "text"), (["1", "T"], "text"),
    (["2024-02-29", None], "date"), (["2023-02-29"], "text"), (["2024-01-02", "2024-01-02T03:04:05Z"], "datetime"),
    (["2024-01-02 03:04"], "datetime"), (["03:04", "23:59:59.5"], "time"), (["24:00"], "text"), (["5d", "1"], "text"),
    ([None, None], "logical"), ([], "logical"), (["x"], "text"),
])
def test_inferred_type(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string").repartition(3)
    assert infer_types(df) == {"a.b": kind} and kind in (*LATTICE, "text")


def test_inferred_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text("When,N,Day,Seen,Id\n2024-01-02 03:04:05,-Inf,2024-02-29,T,01\nNA,2.5,,F,12\n")
    df = read_csv(spark, str(tmp_path / "t.csv"), {"id": "int"}, infer=True, position=True)
    assert dict(df.dtypes[:5]) == {"when": "timestamp", "n": "double", "day": "date", "seen": "boolean", "id": "int"}
    rows = sorted(map(tuple, df.drop("_file", "_block", "_position").collect()), key=lambda r: r[4])
    assert [r[1:2] + r[3:] for r in rows] == [(float("-inf"), True, 1), (2.5, False, 12)]
    assert str(rows[0][2]) == "2024-02-29" and rows[1][0] is None


@pytest.mark.parametrize("multi_line", [False, True])
def test_short_and_long_lines(spark, tmp_path, multi_line):
    path = str(tmp_path / "bad.csv")
    (tmp_path / "bad.csv").write_text('a,b\n1,2\n3\n4,5,6\n\n7,"8,9"\n')
    with pytest.raises(Exception, match="too few or too many fields"):
        read_csv(spark, path, multi_line=multi_line).collect()
    with pytest.raises(Exception, match="too few or too many fields"):
        read_csv(spark, path, multi_line=multi_line).select("b").collect()
    kept = read_csv(spark, path, multi_line=multi_line, bad_lines="drop")
    assert sorted(map(tuple, kept.collect())) == [("1", "2"), ("7", "8,9")] and kept.count() == 2
    assert sorted(r.record for r in csv_rejects(spark, path, multi_line).collect()) == ["3", "4,5,6"]


def narrow_session(spark, size):
    session = spark.newSession()
    for key, value in {"maxPartitionBytes": size, "openCostInBytes": 0, "minPartitionNum": 64}.items():
        session.conf.set(f"spark.sql.files.{key}", str(value))
    return session


@pytest.mark.parametrize("size, end", [(7, "\n"), (64, "\r\n"), (900, "\n")])
def test_line_breaks_in_quotes(spark, tmp_path, size, end):
    """Any splits, also inside quotes and with records over many splits, give what Python's reader gives."""
    dice = random.Random(size)
    words = ["a", '"', ",", "\n", "é", "x y", '""', "\n\n", "long " * 30]
    want = []
    for i in range(3):
        rows = [[f"{i}-{k}", "".join(dice.choice(words) for _ in range(dice.randrange(6))) + "|", "z"] for k in range(40)]
        text = io.StringIO()
        csv.writer(text, lineterminator=end).writerows([["Key", "Some Text", "Last\nname"], *rows])
        (tmp_path / f"f{i}.csv").write_bytes(text.getvalue().encode())
        want += [tuple(r) for r in rows]
    df = read_csv(narrow_session(spark, size), str(tmp_path), multi_line=True, position=True)
    assert df.columns[:3] == ["key", "some_text", "last_name"]
    rows = df.collect()
    assert len({(r._file, r._block) for r in rows}) > 3  # more splits than files
    assert sorted(tuple(r)[:3] for r in rows) == sorted(want)
    in_order = sorted(rows, key=lambda r: (r._file, r._block, r._position))
    assert [r.key for r in in_order] == [w[0] for w in want]


def test_quotes_that_do_not_close(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="do not close"):
        read_csv(spark, str(tmp_path / "q.csv"), multi_line=True)


def test_headers_of_files_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        read_csv(spark, str(tmp_path), multi_line=True).collect()
