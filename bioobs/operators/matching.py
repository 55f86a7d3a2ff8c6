"""Rows whose text contains any word of a list that is itself data."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from bioobs.operators.joins import broadcast_if_small
from bioobs.operators.shape import named
from bioobs.session import shared_folder

# A list of up to this many words travels with the plan; the rows are the same either way.
CARRIED_WORDS = 500
# Characters of a text in which words may start, per piece of the join.
WINDOW = 256


# Cells that count the grams of all texts, and words of 64 bits that mark the listed grams: 2 MB and 1 MB.
CELLS, MARKS = 1 << 18, 1 << 17


def _dense(rows: DataFrame, total: Callable, cells: int) -> Column:
    """``v`` of all rows taken together by ``cell`` from 0, as one array: a scalar subquery, computed once."""
    none = rows.sparkSession.range(cells, numPartitions=1).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("v"))
    filled = rows.unionByName(none).groupBy("cell").agg(total("v").alias("v"))
    ordered = F.sort_array(F.collect_list(F.struct("cell", "v")))
    return filled.agg(ordered.getField("v").alias("a")).scalar()


def match_any(df: DataFrame, text: str, words: DataFrame, word: str) -> DataFrame:
    """Keep rows whose text contains at least one of the words, as a substring.

    A short list, its size checked, becomes one pattern of literals and nothing moves.
    For a longer one the grams of all texts, as long as the shortest word, are counted
    in a fixed number of cells. Each word gives its gram of the emptiest cell; a word
    with an empty cell is in no text. The listed grams are marked in an array of bits,
    by which a text passes over its other grams before anything becomes a row. Equal
    grams meet by an equi-join and ``contains`` decides. The join works on distinct
    texts and selects rows by their text, so rows need no key, and repeated rows each
    stay, as they do with a short list. A missing text or word, and an empty word, match
    nothing. The list is written to the shared folder once, since several steps read it.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "word-list")
    words.select(named(word).alias("__w")).where("length(__w) > 0").distinct().write.parquet(path)
    wanted = spark.read.schema("__w string").parquet(path)
    size = wanted.agg(F.count("*").alias("n"), F.min(F.length("__w")).alias("low"), F.max(F.length("__w")).alias("high")).first()
    if size.n <= CARRIED_WORDS:
        pattern = "|".join(re.escape(r[0]) for r in wanted.sort("__w").collect())
        return df.where(named(text).rlike(pattern) if size.n else F.lit(False))

    def grams(value):
        starts = F.sequence(F.lit(1), F.length(value) - size.low + 1)
        return F.transform(starts, lambda i: F.substring(value, i, F.lit(size.low)))

    def cell(gram):
        return F.xxhash64(gram).bitwiseAND(F.lit(CELLS - 1))

    def mark(gram):
        return F.shiftrightunsigned(F.xxhash64(gram), 18).bitwiseAND(F.lit(MARKS - 1))

    def bit(gram):  # the highest six bits of the hash
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(F.xxhash64(gram), 58).cast("int"))

    # Cut a text into windows first: finding a position in a long text takes time
    # in proportion to the position. Windows overlap by the longest word.
    def windows(overlap: int) -> DataFrame:
        starts = F.sequence(F.lit(1), F.greatest(F.length("__text"), F.lit(1)), F.lit(WINDOW))
        cut = F.transform(starts, lambda i: F.substring(F.col("__text"), i, F.lit(WINDOW + overlap - 1)))
        texts = df.select(named(text).alias("__text")).where(F.length("__text") >= size.low).distinct()
        return texts.select(F.md5("__text").alias("__id"), F.explode(cut).alias("__part")).where(F.length("__part") >= size.low)

    found = windows(size.low).select(F.explode(grams(F.col("__part"))).alias("g"))
    counts = _dense(found.select(cell(F.col("g")).alias("cell"), F.lit(1).cast("long").alias("v")), F.sum, CELLS)
    numbered = wanted.withColumn("__counts", counts)
    ranked = F.transform(grams(F.col("__w")), lambda g: F.struct(F.get("__counts", cell(g).cast("int")).alias("n"), F.xxhash64(g).alias("h"), g.alias("g")))
    rarest = numbered.select("__w", F.array_min(ranked).alias("r")).where("r.n > 0")
    path = shared_folder(spark, "listed-grams")
    rarest.select("__w", F.col("r.g").alias("__g")).write.parquet(path)
    listed = spark.read.schema("__w string, __g string").parquet(path)

    marks = _dense(listed.select(mark(F.col("__g")).alias("cell"), bit(F.col("__g")).alias("v")), F.bit_or, MARKS)
    marked = lambda g: F.get("__marks", mark(g).cast("int")).bitwiseAND(bit(g)) != 0
    pieces = windows(size.high).withColumn("__marks", marks)
    pieces = pieces.select("__id", "__part", F.explode(F.filter(F.array_distinct(grams(F.col("__part"))), marked)).alias("__g"))
    met = pieces.join(broadcast_if_small(listed), "__g").where(F.col("__part").contains(F.col("__w")))
    hits = met.select("__id").distinct()
    return df.join(hits, F.md5(named(text)) == F.col("__id"), "left_semi")
