"""Mixing sources to target weights, in DataFrame functions only.

Per source the documents are laid end to end and cut into blocks of
``block_words`` words. The mix is a number of slots per source, each one block.
Slots are drawn to output shards: the counts of a source over the shards are one
multinomial draw of its slots, so every shard is a random mix while the totals
per source come out as wanted. A slot's number runs through a pseudorandom
permutation of its source's blocks (swap-or-not rounds), once per pass over the
source, and slots meet blocks by (source, block). A block is thus taken equally
often, give or take one, and never more than three times.

Targets: sources share the words of the whole table by weight, none above three
times its own size; the excess is shared among the others by weight. With c the
limits and w the weights, sorted by c / w, the common level is the largest
(total - limits before) / (weights from here on).

A source may hold a third of all rows: positions are running sums within 4096
buckets per source, and joins are by (source, block), so no task holds a source.

Defined cases: a missing text has size 0; documents of size 0 are kept with
nothing taken; a missing source is a source of its own, ordered last; repeated
rows are separate documents, laid out next to each other; an empty table gives an
empty mix. Columns other than the three named are not read. Reruns give the same
mix, for all draws are hashes of the seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bioobs.llm.common import stored, word_count
from bioobs.operators.joins import broadcast_if_small

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
CHUNK = 16_384
ROUNDS = 6
SEED = "mix-1"


def _number(text: Column, digits: int) -> Column:
    """An evenly spread number from the md5 of a text; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def sized(docs: DataFrame, id_column: str, source_column: str, text_column: str) -> DataFrame:
    """``doc_id, src, size``: ``src`` orders by code point with missing sources last. Ids are text or numbers."""
    source, own = docs[source_column].cast("string"), docs[id_column]
    return docs.select(
        (own if docs.schema[id_column].dataType.typeName() == "string" else own.cast("long")).alias("doc_id"),
        F.when(source.isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), source)).alias("src"),
        word_count(docs[text_column]).alias("size"),
    )


def targets(sizes: DataFrame, block_words: int) -> DataFrame:
    """``src, source_size, target, blocks, slots``: one row per source."""
    per_source = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS)).cast("int") + 1)
    ranked = per_source.withColumn("rank", F.row_number().over(Window.orderBy("src")) - 1).withColumn("weight", weight)
    every = Window.partitionBy()
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("source_size").over(by_limit), F.lit(0)) * MOST
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0))
    level = (F.sum("source_size").over(every) - before).cast("double") / weight_left
    levelled = ranked.withColumn("level", level).withColumn("level", F.max("level").over(every))
    target = F.least((F.col("source_size") * MOST).cast("double"), F.col("level") * F.col("weight"))
    return levelled.select(
        "src",
        "source_size",
        target.alias("target"),
        F.ceil(F.col("source_size") / block_words).cast("long").alias("blocks"),
        F.floor(target / block_words + 0.5).cast("long").alias("slots"),
    )


def placed(sizes: DataFrame) -> DataFrame:
    """Adds ``begin``, the document's first word in its source's row of words."""
    bucketed = sizes.withColumn("bucket", _number(F.col("doc_id").cast("string"), 3))
    bucketed = bucketed.withColumn("bucket", F.coalesce("bucket", F.lit(0)))
    own = Window.partitionBy("src", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = bucketed.withColumn("inside", F.coalesce(F.sum("size").over(own), F.lit(0)))
    sums = bucketed.groupBy("src", "bucket").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("src", "bucket", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    return inside.join(starts, ["src", "bucket"]).select(
        "doc_id", "src", "size", (F.col("start") + F.col("inside")).alias("begin")
    )


def _parts(df: DataFrame) -> int:
    """Small rows that grow into many are dealt to a fixed number of tasks, which
    adaptive execution, knowing their size before they grow, does not merge."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _counted_rows(per_row: DataFrame, count: str, index: str, chunk: int) -> DataFrame:
    """Each row ``count`` times, numbered from 0; no array is longer than ``chunk``."""
    chunks = per_row.where(F.col(count) > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / chunk).cast("long"))).alias("__c")
    )
    return (
        chunks.repartition(_parts(per_row), "src", "__c")
        .select(
            "*",
            F.explode(
                F.sequence(F.col("__c") * chunk, F.least((F.col("__c") + 1) * chunk, F.col(count)) - 1)
            ).alias(index),
        )
        .drop("__c")
    )


def _key(*parts: Column) -> Column:
    return F.concat_ws("|", F.lit(SEED), *[p.cast("string") for p in parts])


def permuted(src: Column, turn: Column, index: Column, blocks: Column) -> Column:
    """The block at ``index`` of the source's permutation number ``turn``.

    Swap-or-not: each round pairs x with K - x modulo the number of blocks and lets
    a hash of the pair decide whether to swap, so it is a bijection at every size.
    """

    def one_round(x: Column, r: Column) -> Column:
        key = F.pmod(_number(_key(F.lit("key"), src, turn, r), 12), blocks)
        partner = F.pmod(key - x, blocks)
        swap = _number(_key(F.lit("bit"), src, turn, r, F.greatest(x, partner)), 1) >= 8
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, one_round)


def drawn_slots(wanted: DataFrame, shard_slots: int) -> DataFrame:
    """``shard, src, slot, block`` for every slot of the mix; ``wanted`` as from ``targets``."""
    total = wanted.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    shard = F.pmod(_number(_key(F.lit("shard"), F.col("src"), F.col("draw")), 12), F.lit(shards))
    counts = (
        _counted_rows(wanted, "slots", "draw", CHUNK)
        .groupBy("src", "blocks", shard.alias("shard"))
        .agg(F.count("*").alias("n"))
    )
    earlier = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    last = F.col("first") + F.col("n") - 1
    slots = begun.repartition(_parts(wanted), "src", "shard").select("shard", "src", "blocks", F.explode(F.sequence("first", last)).alias("slot"))
    turn = F.floor(F.col("slot") / F.col("blocks")).cast("long")
    block = permuted(F.col("src"), turn, F.col("slot") % F.col("blocks"), F.col("blocks"))
    return slots.select("shard", "src", "slot", block.alias("block"))


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, whole_times``.

    ``taken`` counts the words that the mix takes of it, repeats included.
    ``whole_times`` is for those who take documents whole: how often to take this
    one, so that every source comes within half of one document to its target. Each is
    taken as often as the target holds its source, and those that begin the row of words
    (which is by a hash of the id) once more, up to the middle of the last.
    ``block_words`` trades the work per word against how near a small source comes
    to its target (within half a block, and three times its last, short block).
    """
    sizes = stored(sized(docs, id_column, source_column, text_column), "sizes")
    wanted = stored(targets(sizes, block_words), "targets")
    taken_blocks = drawn_slots(wanted, shard_slots).groupBy("src", "block").agg(F.count("*").alias("times"))
    row = ["src", "begin", "doc_id", "size"]
    first = F.floor(F.col("begin") / block_words).cast("long")
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words).cast("long")
    pieces = (
        placed(sizes.where(F.col("size") > 0))
        .select(*row, F.explode(F.sequence(first, last)).alias("block"))
        .withColumn(
            "words",
            F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block_words)
            - F.greatest(F.col("begin"), F.col("block") * block_words),
        )
    )
    times = F.coalesce("times", F.lit(0))
    # both sides grow with the corpus, though the planner takes the slots for a small table
    taken = (
        pieces.join(taken_blocks.hint("merge"), ["src", "block"], "left")
        .groupBy(*row)
        .agg(F.sum(F.col("words") * times).alias("taken"))
        .select("src", "doc_id", "size", "taken", "begin")
    )
    none = F.lit(0).cast("long")
    empty = sizes.where(F.col("size") == 0).select(
        "src", "doc_id", "size", none.alias("taken"), none.alias("begin")
    )
    full = F.floor(F.col("target") / F.col("source_size"))
    middle = F.col("begin") + F.col("size") / 2
    whole = full + (middle < F.col("target") - full * F.col("source_size")).cast("long")
    whole = F.when(F.col("size") > 0, whole).otherwise(none).cast("long")
    per_source = broadcast_if_small(wanted.select("src", "source_size", "target"))
    return (
        taken.unionByName(empty)
        .join(per_source, "src")
        .select("doc_id", "size", "source_size", "target", "taken", whole.alias("whole_times"))
    )


def _sql_number(text: str, digits: int) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"


def _sql_rounds() -> str:
    out = []
    for r in range(1, ROUNDS + 1):
        key = _sql_number(f"concat_ws('|', '{SEED}', 'key', src, turn, {r})", 12) + " % blocks"
        bit = _sql_number(f"concat_ws('|', '{SEED}', 'bit', src, turn, {r}, greatest(x, partner))", 1)
        out.append(
            f"p{r} AS (SELECT *, (({key}) - x + blocks) % blocks AS partner FROM r{r - 1}), "
            f"r{r} AS (SELECT src, blocks, turn, CASE WHEN {bit} >= 8 THEN partner ELSE x END AS x FROM p{r})"
        )
    return ", ".join(out)


ORACLE = f"""
WITH sizes AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 'a' || source END AS src,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), ranked AS (
  SELECT *, ([{', '.join(map(str, WEIGHTS))}])[(row_number() OVER (ORDER BY src) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM (SELECT src, sum(size)::BIGINT AS source_size FROM sizes GROUP BY src)
), levels AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - {MOST} * coalesce(sum(source_size) OVER earlier, 0)::BIGINT)::DOUBLE
    / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER earlier, 0))::DOUBLE AS level
  FROM ranked WINDOW earlier AS (ORDER BY source_size::DOUBLE / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), wanted AS (
  SELECT src, source_size, least(({MOST} * source_size)::DOUBLE, (max(level) OVER ()) * weight) AS target,
    ceil(source_size::DOUBLE / {BLOCK_WORDS})::BIGINT AS blocks FROM levels
), planned AS (SELECT *, floor(target / {BLOCK_WORDS} + 0.5)::BIGINT AS slots FROM wanted
), r0 AS (
  SELECT src, blocks, slot // blocks AS turn, slot % blocks AS x
  FROM (SELECT src, blocks, unnest(range(slots)) AS slot FROM planned)
), {_sql_rounds()}, times AS (SELECT src, x AS block, count(*) AS times FROM r{ROUNDS} GROUP BY ALL
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY src ORDER BY bucket, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM (SELECT *, coalesce({_sql_number("doc_id::VARCHAR", 3)}, 0) AS bucket FROM sizes WHERE size > 0)
), pieces AS (
  SELECT src, doc_id, size, begin, unnest(range(begin // {BLOCK_WORDS}, (begin + size - 1) // {BLOCK_WORDS} + 1)) AS block
  FROM placed
), taken AS (
  SELECT p.src, p.doc_id, p.size, sum(coalesce(t.times, 0) * (least(begin + size, (p.block + 1) * {BLOCK_WORDS})
    - greatest(begin, p.block * {BLOCK_WORDS})))::BIGINT AS taken
  FROM pieces p LEFT JOIN times t ON p.src = t.src AND p.block = t.block GROUP BY p.src, p.doc_id, p.size, p.begin
  UNION ALL SELECT src, doc_id, size, 0 FROM sizes WHERE size = 0
)
SELECT doc_id, size, source_size, target, taken FROM taken JOIN wanted USING (src)
"""
