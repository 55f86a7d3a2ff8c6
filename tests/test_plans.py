"""What the planner makes of the operators: pruning, pushdown, no needless moves."""

import contextlib
import io
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from bioobs.operators.joins import natural_join
from bioobs.operators.ordering import first_per_group
from bioobs.plans.occurrence import clip_to_boundary
from bioobs.schemas import RANKS
from checkqueries.jobs import boundary, occurrence
from checkqueries.registry import table

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def stored_occurrence(spark, tmp_path):
    path = str(tmp_path / "occ")
    missing = [F.lit(None).cast("string").alias(r) for r in RANKS if r not in ("kingdom", "phylum", "class")]
    occurrence(spark, FOLDER).select("*", *missing, F.lit("x").alias("unused")).write.parquet(path)
    return spark.read.parquet(path)


def test_clip_moves_no_points(spark, tmp_path):
    stored = stored_occurrence(spark, tmp_path)
    text = plan(clip_to_boundary(stored, boundary(spark, FOLDER)).drop("unused"))
    assert "BroadcastHashJoin LeftSemi BuildRight" in text
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(decimallongitude" in pushed and "LessThanOrEqual(decimallatitude" in pushed
    assert "unused" not in re.search(r"ReadSchema: (.*)", text).group(1)
    # the branch of the points, above the first scan, has no exchange
    top = text.split("BroadcastExchange")[0]
    assert "Exchange" not in top and "Sort" not in top


def test_no_cross_join_or_python_in_the_check_queries(spark):
    allowed_python = {"q_convex_hull", "q_request_region", "q_request_regions", "q_request_reuse"}
    for name, query in entry.CHECK_QUERIES.items():  # the text operators may use Python
        text = plan(query(spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name
        if name not in allowed_python:
            assert not re.search("InPandas|EvalPython|PythonUDF|InArrow", text), name


def test_left_join_with_value_filter_becomes_inner(spark):
    left = table(spark, FOLDER, "part").select(F.col("p_partkey").alias("k"))
    right = table(spark, FOLDER, "lineitem").select(F.col("l_partkey").alias("k"), "l_quantity")
    text = plan(natural_join(left, right).where("l_quantity <> 0"))
    assert "LeftOuter" not in text and re.search(r"Join (type: )?Inner", text)


def test_first_per_group_limits_before_the_shuffle(spark):
    rows = table(spark, FOLDER, "orders")
    text = plan(first_per_group(rows, ["o_custkey"], F.col("o_totalprice").desc(), F.col("o_orderkey")))
    assert text.count("WindowGroupLimit") >= 2


def test_scan_prunes_and_pushes(spark):
    text = plan(entry.queries()["q_scan"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in text
    assert "EqualTo(l_returnflag,R)" in text


def test_partitioned_write_rebalances(spark):
    df = table(spark, FOLDER, "orders").hint("rebalance", F.col("o_orderstatus"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)


def test_partition_folder_pruned_by_snapshot(spark, tmp_path):
    from bioobs.operators.ordering import latest_snapshot

    path = str(tmp_path / "atlas")
    spark.range(100).select("id", F.format_string("2024-0%d", F.col("id") % 5 + 1).alias("snapshot_date")).write.partitionBy("snapshot_date").parquet(path)
    atlas = spark.read.parquet(path)
    newest = latest_snapshot(atlas, atlas.select("snapshot_date"), "snapshot_date")
    assert newest.count() == 20
    assert re.search(r"PartitionFilters: \[.*snapshot_date.*Subquery", plan(newest))
