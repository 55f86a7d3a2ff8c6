"""Records of CSV files with line breaks inside quotes, each file read by many tasks.

A split of a file cannot tell whether it begins inside quotes, but the number of quotes
in all splits before it can. One pass counts them, a row for each split; a prefix over
these rows gives the state in which each split begins. In the second pass the lines of
every split, a group of bounded size, are put together from the right state. What a split
cannot finish, at most one piece at either end, is joined with the pieces of its
neighbours.

Quotes must enclose whole fields and be doubled inside them, so that a file has an even
number of quotes; one with an odd number is refused.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from bioobs.operators.joins import broadcast_if_small
from bioobs.operators.ordering import BLOCK, FILE, POSITION

# what a piece is: a whole record, one cut at its end, at its beginning, or at both
WHOLE, BEGINNING, ENDING, MIDDLE = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), quotes.alias("quotes"), "value"
    )


def split_states(spark: SparkSession, path: str) -> dict[tuple[str, int], bool]:
    """For every split that has lines: whether it begins inside quotes. As many entries as Spark plans splits."""
    counts = _lines(spark, path).groupBy(FILE, BLOCK).agg((F.sum("quotes") % 2).alias("odd"))
    before = W.partitionBy(FILE).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(FILE)
    states = counts.select(FILE, BLOCK, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"), (F.sum("odd").over(whole) % 2).alias("left"))
    found = states.collect()
    open_files = sorted({r[FILE] for r in found if r.left})
    if open_files:
        raise ValueError(f"quotes do not close in {open_files[:3]}")
    return {(r[FILE], r[BLOCK]): r.inside for r in found}


def _pieces(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``_file, _block, _position, piece, record``: the lines of each split as records and parts of records."""
    order = W.partitionBy(FILE, BLOCK).orderBy("line")
    known = F.when(F.col("inside").isNotNull(), F.col("inside").cast("long")).otherwise(
        F.raise_error(F.lit("the file was split otherwise when its quotes were counted")).cast("long")
    )
    split = lines.withColumn("line", F.monotonically_increasing_id()).join(broadcast_if_small(states), [FILE, BLOCK], "left").withColumn("inside", known)
    before = F.coalesce(F.sum("quotes").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("inside")
    placed = split.withColumns({POSITION: (F.row_number().over(order) - 1).cast("long"), "before": before})
    begins = F.when(F.col("before") % 2 == 0, F.col(POSITION))
    of_record = placed.withColumn("of", F.last(begins, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    text = F.sort_array(F.collect_list(F.struct(POSITION, "value"))).getField("value")
    whole = of_record.groupBy(FILE, BLOCK, "of").agg(
        F.array_join(text, "\n").alias("record"), F.min(POSITION).alias(POSITION), (F.sum("quotes") % 2 == 1).alias("odd"), F.first("inside").alias("inside")
    )
    began = F.col("of").isNotNull()
    closed = F.when(began, ~F.col("odd")).otherwise(F.col("odd"))  # what does not begin here is inside quotes at first
    piece = F.when(began & closed, WHOLE).when(began, BEGINNING).when(closed, ENDING).otherwise(MIDDLE)
    return whole.select(FILE, BLOCK, POSITION, piece.alias("piece"), "record")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` with its place: ``_file, _block, _position``. Blank records are left out.

    The place is that of the first line.
    """
    states = [(*split, inside) for split, inside in split_states(spark, path).items()]
    pieces = _pieces(_lines(spark, path), spark.createDataFrame(states, f"{FILE} string, {BLOCK} long, inside boolean"))
    whole = pieces.where(F.col("piece") == WHOLE).drop("piece")
    # of one split, the piece that ends a record stands before the one that begins the next
    order = W.partitionBy(FILE).orderBy(BLOCK, POSITION)
    cut = pieces.where(F.col("piece") != WHOLE).withColumn("of", F.sum(F.when(F.col("piece") == BEGINNING, 1).otherwise(0)).over(order))
    parts = F.sort_array(F.collect_list(F.struct(BLOCK, POSITION, "record")))
    joined = cut.groupBy(FILE, "of").agg(parts.alias("p"))
    joined = joined.select(FILE, F.col(f"p.{BLOCK}")[0].alias(BLOCK), F.col(f"p.{POSITION}")[0].alias(POSITION), F.array_join("p.record", "\n").alias("record"))
    records = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r$", ""))
    return records.where(F.trim("record") != "")


def parsed_records(records: DataFrame, columns: list[str], bad: str, options: Mapping[str, str]) -> DataFrame:
    """The fields of every record as text columns; ``bad`` holds a record with too few or too many fields."""
    fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, bad])
    parsed = F.from_csv("record", fields, {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    return records.withColumn("__fields", parsed).select("__fields.*", FILE, BLOCK, POSITION)
