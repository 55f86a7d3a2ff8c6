import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from bioobs.operators.joins import broadcast_if_small, expect_unique, impute_max, natural_join, recycle
from bioobs.operators.matching import match_any
from bioobs.operators.ordering import (
    BLOCK,
    FILE_ORDER,
    POSITION,
    fill_down,
    first_per_group,
    positional_zip,
    with_file_position,
    with_key_chunk,
    with_ordinal,
)
from bioobs.operators.shape import (
    bind_rows,
    conform,
    drop_all_null,
    nest,
    pivot_wider,
    relocate,
    unnest_rows,
)
from bioobs.operators.taxonomy import classify, ranks_wide, species_with_ranks
from bioobs.schemas import BACKBONE_SCHEMA, CANDIDATE_SCHEMA
from checkqueries.relations import q_left_composite


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_null_keys_match_and_copies_multiply(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "k string, v int")
    assert rows(natural_join(left, right)) == [(1, "a", 10), (1, "a", 11), (2, None, 12), (3, "z", None)]
    assert rows(natural_join(left, right, "left_anti")) == [(3, "z")]
    with pytest.raises(ValueError):
        natural_join(left, right.select("v"))


def test_exploded_sites_are_not_broadcast(spark, tmp_path):
    """The planner takes their size before the explode, an eighth of it, for small."""
    parts = [1, 2, 3, 95, 95, None]
    lines = [(k, p, (p or 0) + i, k % 3, q) for k, (p, i, q) in enumerate([(1, 0, 2.0), (1, 8, 3.0), (2, 7, 5.0), (3, 1, 4.0), (95, 2, 1.0), (95, 6, 7.0), (None, 1, 1.0), (2, 0, None), (9, 0, 1.0)])]
    lines.append((50, 95, 2, 1, 6.0))
    spark.createDataFrame([(p,) for p in parts], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = q_left_composite(spark, str(tmp_path))
    sites = [(p, (p + i) % 100) for p in parts if p is not None for i in range(8)]
    expected = [(p, s, o, n, q * (p % 3)) for p, s in sites for o, lp, ls, n, q in lines if (lp, ls) == (p, s) and q and p % 3]
    assert len(expected) == 6 and rows(found) == sorted(expected, key=str)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_expect_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(PySparkException, match="duplicate key"):
        expect_unique(df, ["k"]).collect()
    assert expect_unique(df, ["v"]).count() == 2


def test_recycle_needs_one_row(spark):
    df = spark.range(3)
    two = spark.createDataFrame([("a",), ("b",)], "m string")
    assert rows(recycle(df, two.limit(1))) == [(0, "a"), (1, "a"), (2, "a")]
    for wrong in (two, two.where("m = 'c'")):
        with pytest.raises(Exception, match="exactly one row"):
            recycle(df, wrong).collect()


def test_impute_max_of_all_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    assert rows(impute_max(df, "v")) == [(1, None), (2, None)]


def test_broadcast_only_after_size_check(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(spark.range(5).join(broadcast_if_small(spark.range(10)), "id"))
    assert "broadcast" not in plan(spark.range(5).join(broadcast_if_small(spark.range(200_001)), "id"))


def test_drop_all_null_and_conform(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b string, `c.d` string")
    assert drop_all_null(df).columns == ["a", "c.d"]
    target = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.DoubleType())])
    assert conform(df, target).dtypes == [("b", "string"), ("a", "double")]
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("b"), target)


def test_relocate(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert relocate(df, ["d", "zz", "b"]).columns == ["d", "b", "a", "c"]
    assert relocate(df, ["d", "a"], before="c").columns == ["b", "d", "a", "c"]


def test_nest_keeps_copies_and_nulls(spark):
    data = [("k", "a"), ("k", "a"), ("k", None), ("m", "b"), (None, "c")] + [("k", str(i)) for i in range(50)]
    df = spark.createDataFrame(data, "k string, v string")
    for parts in (1, 4):
        nested = nest(df, ["k"], ["v"], "items", parts)
        assert rows(unnest_rows(nested, "items")) == sorted(data, key=str)
    assert nested.where("k = 'k'").count() == 4


def test_pivot_wider(spark):
    df = spark.createDataFrame([("q", "genus", "G"), ("q", "kingdom", "K"), ("r", "genus", "H")], "query string, rank string, name string")
    assert rows(pivot_wider(df, ["query"], "rank", "name", ["kingdom", "genus"])) == [("q", "K", "G"), ("r", None, "H")]


def test_bind_rows_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(1,)], "a int")
    assert rows(bind_rows(a, a, b)) == [(1, "x"), (1, "x"), (1, None)] or rows(bind_rows(a, a, b)) == [(1, None), (1, "x"), (1, "x")]


@pytest.mark.parametrize("split", ["1000", "128m"])
def test_fill_down_follows_file_order(spark, tmp_path, split):
    random.seed(5)
    expected, last = [], None
    for name in ("a.csv", "b.csv"):
        lines = ["n,v"]
        for _ in range(700):
            n = len(expected)
            v = f"v{n}" if random.random() < 0.01 and n > 30 else ""
            last = v or last
            lines.append(f"{n},{v}")
            expected.append((n, last))
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = spark.read.schema("n int, v string").option("header", True).csv(str(tmp_path))
        filled = fill_down(with_file_position(df), ["v"], FILE_ORDER["chunk"], POSITION)
        got = [tuple(r) for r in filled.select("n", "v").orderBy("n").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expected


def test_ordinal_is_global(spark):
    df = with_key_chunk(spark.range(1000).selectExpr("id * 3 as k"), "k", 100)
    got = with_ordinal(df, "i", [BLOCK], "k").select("k", "i").orderBy("k").collect()
    assert [(r.k, r.i) for r in got] == [(3 * i, i + 1) for i in range(1000)]


def test_positional_zip_refuses_unequal_lengths(spark):
    a = spark.range(1, 4).selectExpr("id as i", "id * 10 as a")
    b = spark.range(1, 4).selectExpr("id as i", "id * 100 as b")
    assert rows(positional_zip(a, b, "i").select("a", "b")) == [(10, 100), (20, 200), (30, 300)]
    for longer, shorter in ((a, b.where("i < 3")), (a.where("i < 3"), b)):
        with pytest.raises(PySparkException, match="different length"):
            positional_zip(longer, shorter, "i").collect()


def test_first_per_group(spark):
    df = spark.createDataFrame([("q", 2, 7), ("q", 1, 9), ("r", 1, 3)], "query string, candidate_rank int, taxon_id long")
    assert rows(first_per_group(df, ["query"], F.col("candidate_rank"))) == [("q", 1, 9), ("r", 1, 3)]


def test_match_any_is_literal_substring(spark):
    df = spark.createDataFrame([(1, "Nes19d E"), (2, "Foo.R"), (3, "FooxR"), (4, None), (5, "")], "id int, t string")
    words = spark.createDataFrame([("Nes19",), ("o.R",), (None,), ("",)], "w string")
    assert rows(match_any(df, "t", words, "w").select("id")) == [(1,), (2,)]
    assert match_any(df, "t", words.where("w = 'none'"), "w").count() == 0


def test_match_any_long_list_agrees_with_brute_force(spark):
    random.seed(2)
    texts = [(i, "".join(random.choice("abc") for _ in range(random.randint(0, 30)))) for i in range(200)]
    # long texts whose only match lies anywhere, also across a window's end
    texts += [(1000 + at, "ddddd" * (at // 5) + "d" * (at % 5) + "abcdé" + "d" * (at % 7)) for at in range(240, 530)]
    words = ["".join(random.choice("abc") for _ in range(random.randint(4, 9))) for _ in range(900)] + ["abcdé"]
    df = spark.createDataFrame(texts, "id int, t string")
    got = match_any(df, "t", spark.createDataFrame([(w,) for w in words], "w string"), "w")
    assert rows(got) == sorted([x for x in texts if any(w in x[1] for w in words)], key=str)


def backbone(spark):
    return spark.createDataFrame(
        [(1, None, "kingdom", "Animalia"), (2, 1, "phylum", "Chordata"), (3, 2, "class", "Aves"), (4, 3, "genus", "Larus"),
         (5, 4, "species", "Larus canus"), (6, None, "kingdom", "Plantae"), (7, 6, "genus", "Larus")],
        BACKBONE_SCHEMA,
    )


def test_classification(spark):
    candidates = spark.createDataFrame(
        [("Larus canus", 1, 5), ("Larus spp.", 2, 7), ("Larus spp.", 1, 4), ("lost", 1, 99)], CANDIDATE_SCHEMA
    )
    long = classify(candidates, backbone(spark))
    assert rows(long.where("query = 'Larus spp.'").select("rank", "name")) == [
        ("class", "Aves"), ("genus", "Larus"), ("kingdom", "Animalia"), ("phylum", "Chordata")]
    wide = {r["query"]: r for r in ranks_wide(long).collect()}
    assert wide["Larus canus"]["species"] == "Larus canus" and wide["Larus spp."]["species"] is None
    species = spark.createDataFrame([("a", "Larus canus"), ("b", "nobody")], "code string, scientific_name string")
    extra = spark.createDataFrame([("GULL", "Larus spp.")], "code string, scientific_name string")
    full = species_with_ranks(species, candidates, backbone(spark), extra)
    assert rows(full.select("code", "class", "species")) == [("GULL", "Aves", None), ("a", "Aves", "Larus canus"), ("b", None, None)]


def test_match_any_needs_no_key(spark):
    df = spark.createDataFrame([(1, "has abc"), (1, "nothing"), (None, "abc too"), (1, "has abc"), (2, None)], "id int, t string")
    words = spark.createDataFrame([("abc",), (None,)], "w string")
    long = words.unionByName(spark.range(700).select(F.concat(F.lit("zz"), "id").alias("w")))
    for each in (words, long):
        assert sorted(match_any(df, "t", each, "w").collect(), key=str) == sorted(
            [(1, "has abc"), (1, "has abc"), (None, "abc too")], key=str
        )


def test_classify_fails_on_an_unknown_parent(spark):
    taxa = spark.createDataFrame(
        [(1, 99, "genus", "G"), (2, 1, "species", "S")], "taxon_id long, parent_id long, rank string, name string"
    )
    found = spark.createDataFrame([("q", 1, 2)], "query string, candidate_rank int, taxon_id long")
    with pytest.raises(PySparkException, match="unknown parent"):
        classify(found, taxa).collect()


def test_classify_any_depth_and_only_its_own_faults(spark):
    taxa = [(i, i - 1 if i > 1 else None, f"r{i}", f"n{i}") for i in range(1, 41)]
    taxa += [(50, 51, "a", "A"), (51, 52, "b", "B"), (52, 51, "c", "C"), (60, 60, "d", "D")]
    tree = spark.createDataFrame(taxa, "taxon_id long, parent_id long, rank string, name string")
    asked = lambda *ids: spark.createDataFrame([(f"q{i}", 1, i) for i in ids], "query string, candidate_rank int, taxon_id long")
    got = rows(classify(asked(40, 1), tree))
    assert got == sorted([("q1", "r1", "n1")] + [("q40", f"r{i}", f"n{i}") for i in range(1, 41)], key=str)
    for cyclic in (50, 51, 60):
        with pytest.raises(PySparkException, match="cycle"):
            classify(asked(cyclic), tree).collect()
