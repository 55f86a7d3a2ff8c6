"""N-gram Jaccard join by parity sketches, exact.

Every document is its set of five-word shingles. Sets of about one size share a
sketch layout: shingles XOR 64-bit words into blocks, so two sets that differ in
d shingles differ in at most d blocks (``shingles.py``). By the pigeonhole
principle a bounded number of a set's blocks, the rarest first, must meet an equal
block of any set it links with. From there:

1. Equal sets become one class. Each task first counts its blocks, so that frequent
   ones (shared passages) are known and come last in the order of choice.
2. Chosen blocks are dealt by key and sorted. Within a key every class is paired
   with the first one only: as many pairs as rows, however large the group.
3. Pairs pass a bit sketch (the bits that differ are at most the symmetric
   difference), then the sets themselves decide. Links make components.
4. Where a key still joins several components: in groups of up to ``SMALL_GROUP``
   rows the other pairs are tested too; larger groups are cut into pieces of bounded
   size, and pairs of pieces are compared by bit sketch inside tasks, across
   components only. Survivors are verified. Where they would be many more than the
   rows, first each component's most similar pair is, then, across the components
   this gives, all.

No pair that can link is left out: it is tested, or both ends are in one
component already. Large groups are never expanded to rows of pairs; what leaves them
are pairs that the sketches cannot tell from links.

Defined cases: a missing text, and one without words, has an empty set, links with
nothing and is its own component; repeated rows are one class; a row without an id
belongs to its class but names no component (NULL if the class has no id at all);
extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bioobs.llm.common import arrow_schema, batch_of, map_rows, stored
from bioobs.llm.components import components
from bioobs.llm.packing import packed, unpacked
from bioobs.llm.shingles import (
    bit_sketch,
    chosen_keys,
    differences,
    grids_of,
    linked,
    may_link,
    shingle_set,
    sketch_keys,
    slack,
)
from bioobs.llm.words import mixed
from bioobs.operators.joins import broadcast_if_small

SMALL_GROUP = 12
# rows of a large group that are compared at a time
PIECE_ROWS = 4_096
# blocks a task counts at a time, and how often one must occur there to be reported
COUNTED_BLOCKS = 3_000_000
REPORTED = 8
# about how many blocks a document gives; only the widths of keys and ranges depend on it
BLOCKS_OF_DOCUMENT = 256
# pairs that a group may give at first, by its rows
PAIRS_PER_ROW = 4
# pairs a task remembers having given
REMEMBERED_PAIRS = 200_000
# a block is frequent if it occurs this often, or in one of so many documents
FREQUENT, FREQUENT_SHARE = 16, 5_000

SURVEY = "doc_id long, text_hash long, n long, class long, sketch binary, key long, times long, short long"


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def class_of(values: np.ndarray) -> int | None:
    """A 64-bit name of a set; NULL for the empty one."""
    if not len(values):
        return None
    return int(_signed(mixed(np.array([values.sum(dtype=np.uint64)]), len(values)))[0])


class _Survey:
    """Per document its class and bit sketch; per task its frequent blocks and the grids in
    which a set has too few blocks."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SURVEY)
        blocks, count = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                out = []
                for doc_id, text, text_hash in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns)):
                    values = shingle_set(text)
                    sketch = bit_sketch(values) if len(values) else None
                    out.append((doc_id, text_hash, len(values), class_of(values), sketch, None, None, None))
                    for grid in grids_of(len(values)) if len(values) else ():
                        keys = sketch_keys(values, grid, False)
                        if len(keys) <= differences(len(values), grid):
                            out.append((None,) * 7 + (grid,))
                        blocks.append(keys)
                        count += len(keys)
                yield batch_of(out, schema)
                if count >= COUNTED_BLOCKS:
                    yield self._frequent(blocks, schema)
                    blocks, count = [], 0
        if blocks:
            yield self._frequent(blocks, schema)

    @staticmethod
    def _frequent(blocks: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
        keys, times = np.unique(np.concatenate(blocks), return_counts=True)
        often = times >= REPORTED
        pairs = zip(_signed(keys[often]).tolist(), times[often].tolist())
        return batch_of([(None,) * 5 + (k, t, None) for k, t in pairs], schema)


BLOCKS = "range long, start long, steps binary, classes binary, place binary"


class _Blocks:
    """The chosen blocks of each class the task meets, packed: a row for each range of keys.

    Of a key the highest ``bits`` stay. They name a block well enough: two that share
    them are one more pair to test.
    """

    def __init__(self, common, levels, plain: set[int], bits: int, ranges: int):
        self.common, self.levels, self.plain, self.bits, self.ranges = common, levels, plain, bits, ranges

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        keys, names, count = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for text in batch.column(0).slice(at, 512).to_pylist():
                    values = shingle_set(text)
                    name = class_of(values)
                    if name is None or name in met:
                        continue
                    met.add(name)
                    for grid in grids_of(len(values)):
                        own = chosen_keys(
                            sketch_keys(values, grid, grid in self.plain),
                            differences(len(values), grid) + 1,
                            self.common,
                            self.levels,
                        )
                        keys.append(own)
                        names.append(np.full(len(own), name, np.int64))
                        count += len(own)
                if count >= COUNTED_BLOCKS:
                    yield self._packed(np.concatenate(keys), np.concatenate(names))
                    keys, names, count = [], [], 0
        if keys:
            yield self._packed(np.concatenate(keys), np.concatenate(names))

    def _packed(self, keys: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(keys)
        keys, names = (keys[order] >> np.uint64(64 - self.bits)).astype(np.int64), names[order]
        of = (keys >> (self.bits - 24)) * self.ranges >> 24
        bounds = np.flatnonzero(np.diff(of, prepend=-1))
        rows = []
        for lo, hi in zip(bounds, [*bounds[1:], len(of)]):
            classes, place = np.unique(names[lo:hi], return_inverse=True)
            steps = packed(np.diff(keys[lo:hi], prepend=keys[lo]))
            rows.append((int(of[lo]), int(keys[lo]), steps, classes.tobytes(), packed(place)))
        return batch_of(rows, arrow_schema(BLOCKS))


def _unpacked_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_Blocks`` sorted by range to ``key, class``, sorted: one range in memory at a time."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    for _, own in groupby(rows(), key=lambda r: r[0]):
        keys, names = [], []
        for _, start, steps, classes, place in own:
            keys.append(start + np.cumsum(unpacked(steps).astype(np.int64)))
            names.append(np.frombuffer(classes, np.int64)[unpacked(place)])
        keys, names = np.concatenate(keys), np.concatenate(names)
        order = np.lexsort((names, keys))
        for at in range(0, len(order), 1 << 16):
            part = order[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(names[part])], names=["key", "class"])


def _shared_of_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _shared_blocks(_unpacked_blocks(batches))


def _shared_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``key, class`` to ``key, class, first`` for keys with two classes or more.

    Of two classes only the second is given, without the key: the pair is all there
    is to test. A pair is given without its key once per task as a rule. Streams: of
    a group only two classes and the last one are held.
    """
    key = first = second = last = None
    given: set[tuple] = set()

    def pair(c: int) -> list[tuple]:
        if (c, first) in given:
            return []
        if len(given) > REMEMBERED_PAIRS:
            given.clear()
        given.add((c, first))
        return [(None, c, first)]

    for batch in batches:
        keys, names = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        # rows that stand alone in their key cost nothing here
        same = np.ones(len(keys), bool)
        if len(keys):
            same[1:-1] = (keys[1:-1] == keys[:-2]) | (keys[1:-1] == keys[2:])
        out = []
        for k, c in zip(keys[same].tolist(), names[same].tolist()):
            if k != key:
                key, first, second, last = k, c, None, c
            elif c != last:
                out += pair(c)
                if second is None:
                    second = c
                else:
                    if last == second:
                        out += [(key, first, first), (key, second, first)]
                    out.append((key, c, first))
                last = c
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, type=pa.int64()) for v in (zip(*out) if out else ((), (), ()))],
            names=["key", "class", "first"],
        )


def _open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``key, class, label`` to ``large, a, b``, for groups of several labels.

    Of a small one its pairs of classes across labels, of a large one its key and
    number of rows. Streams: no more than a batch and a small group are held.
    """
    held: list[np.ndarray] = [np.empty(0, np.int64)] * 3  # the rows of a group that may go on
    more = 0  # rows of it that are counted but not held

    def close(names, labels, rows) -> list[tuple]:
        if rows > SMALL_GROUP:
            return [(1, None, rows)]
        return [
            (0, min(a, b), max(a, b))
            for i, (a, one) in enumerate(zip(names, labels))
            for b, other in zip(names[:i], labels[:i])
            if one != other
        ]

    def groups(keys, names, labels, last_is_open: bool):
        nonlocal held, more
        out = []
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
        ends = np.append(starts[1:], len(keys))
        several = np.zeros(len(starts), bool)
        if len(starts):
            several = np.minimum.reduceat(labels, starts) != np.maximum.reduceat(labels, starts)
        done = len(starts) - int(last_is_open and len(starts) > 0)
        extra = more
        for g in np.flatnonzero(several[:done]):
            s, e = starts[g], ends[g]
            rows = int(e - s) + (extra if g == 0 else 0)
            found = close(names[s:e].tolist(), labels[s:e].tolist(), rows)
            out += [(kind, int(keys[s]), b) if kind else (kind, a, b) for kind, a, b in found]
        if done < len(starts):
            s = starts[done]
            kept = slice(s, s + SMALL_GROUP + 1)
            own = [c[kept] for c in (keys, names, labels)]
            over = max(0, len(keys) - s - SMALL_GROUP - 1)
            if over and several[done]:
                # one row of another label must stay to tell
                other = s + int(np.argmax(labels[s:] != labels[s]))
                own = [np.append(c[s : s + SMALL_GROUP], c[other]) for c in (keys, names, labels)]
            held, more = own, over + (extra if done == 0 else 0)
        else:
            held, more = [np.empty(0, np.int64)] * 3, 0
        return out

    for batch in batches:
        if batch.num_rows:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            yield batch_of(groups(*(np.concatenate(p) for p in zip(held, columns)), True), PAIRS)
    yield batch_of(groups(*held, False), PAIRS)


PAIRS = arrow_schema("large int, a long, b long")


class _ComparePieces:
    """Rows sorted by piece pair to ``large, a, b``: pairs of classes across labels that the
    sketches let pass.

    If those are many more than the rows, each label gives its most similar pair only, and
    the key is given with ``large = 1``: its labels must be looked at again. With ``every``
    all pairs are given.
    """

    def __init__(self, every: bool):
        self.every = every

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple] = set()  # most repeats go here, the others when pairs meet
        for unit in _units(batches):
            found = self._pairs(unit)
            if len(given) > REMEMBERED_PAIRS:
                given.clear()
            out = [pair for pair in dict.fromkeys(found) if pair not in given]
            given.update(out)
            yield batch_of(out, PAIRS)

    def _pairs(self, members: list[tuple]) -> list[tuple]:
        key, low, high = members[0][:3]
        left = [m for m in members if m[3] == low]
        right = left if low == high else [m for m in members if m[3] == high]
        by_length: dict[int, list[tuple]] = {}
        for m in right:
            by_length.setdefault(len(m[7]), []).append(m)
        packed = [
            (
                np.array([m[4] for m in same], np.int64),
                np.array([m[5] for m in same], np.int64),
                np.array([m[6] for m in same], np.int64),
                np.frombuffer(b"".join(m[7] for m in same), np.uint8).reshape(len(same), -1),
            )
            for same in by_length.values()
        ]
        best: dict[int, tuple] = {}
        pairs, most = [], len(members) * PAIRS_PER_ROW
        for _, _, _, _, name, label, size, sketch in left:
            own = np.frombuffer(sketch, np.uint8)
            for names, labels, sizes, sketches in packed:
                at = np.flatnonzero(labels != label)
                if not len(at):
                    continue
                room = slack(size, own, sizes[at], sketches[at])
                top = int(room.argmax())
                if room[top] > best.get(label, (-1.0,))[0]:
                    best[label] = (float(room[top]), name, int(names[at[top]]))
                if self.every or len(pairs) <= most:
                    pairs += [(0, min(name, o), max(name, o)) for o in names[at[room >= 0]].tolist()]
        if self.every or len(pairs) <= most:
            return pairs
        return [(0, min(a, b), max(a, b)) for _, a, b in best.values()] + [(1, key, 0)]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one piece pair at a time: two pieces at most."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    for _, unit in groupby(rows(), key=lambda r: r[:3]):
        yield list(unit)


class JaccardJoin:
    """One run of the join over a table of documents."""

    def __init__(self, docs: DataFrame, id_column: str, text_column: str):
        self.spark: SparkSession = docs.sparkSession
        self.docs = docs.select(
            docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")
        ).withColumn("text_hash", F.xxhash64("text"))
        survey = stored(self.docs.mapInArrow(_Survey(), SURVEY), "survey")
        self.members = survey.where(F.col("n").isNotNull()).select("doc_id", "text_hash", "n", "class")
        self.sketches = stored(
            survey.where(F.col("class").isNotNull())
            .groupBy("class")
            .agg(
                F.min("doc_id").alias("doc_id"),
                F.min(F.struct("doc_id", "text_hash")).alias("row"),
                F.first("n").alias("n"),
                F.first("sketch").alias("sketch"),
            ),
            "sketches",
        )
        self.survey = survey

    def shared_blocks(self) -> DataFrame:
        """``key, class, first`` of chosen blocks that several classes have; see ``_shared_blocks``."""
        documents = self.members.count()
        limit = max(FREQUENT, documents // FREQUENT_SHARE)
        # at most as many as blocks of FREQUENT_SHARE documents, whatever the corpus
        common = (
            self.survey.where(F.col("key").isNotNull())
            .groupBy("key")
            .agg(F.sum("times").alias("times"))
            .where(F.col("times") >= limit)
            .toPandas()
        )
        keys = common["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        levels = np.log2(common["times"].to_numpy(np.int64)[order]).astype(np.int64)
        short = self.survey.where(F.col("short").isNotNull()).select("short").distinct().collect()
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # as many key bits as tell nearly all blocks apart, and ranges of about as many blocks as a task packs
        bits = min(60, max(40, (documents * BLOCKS_OF_DOCUMENT).bit_length() + 14))
        ranges = max(parts, documents * BLOCKS_OF_DOCUMENT // COUNTED_BLOCKS)
        blocks = self.docs.select("text").mapInArrow(
            _Blocks(keys[order], levels, {r.short for r in short}, bits, ranges), BLOCKS
        )
        dealt = blocks.repartitionById(parts, (F.col("range") % parts).cast("int")).sortWithinPartitions("range")
        return stored(dealt.mapInArrow(_shared_of_packed, "key long, class long, first long"), "blocks")

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs(a, b)`` that their bit sketches let pass."""
        side = self.sketches.select("class", "n", "sketch")

        @F.pandas_udf(T.BooleanType())
        def passes(n_a, s_a, n_b, s_b):
            import pandas as pd

            return pd.Series(
                [
                    bool(may_link(i, np.frombuffer(a, np.uint8), np.int64(j), np.frombuffer(b, np.uint8)))
                    for i, a, j, b in zip(n_a, s_a, n_b, s_b)
                ],
                dtype=bool,
            )

        return (
            pairs.join(side.toDF("a", "n_a", "s_a"), "a")
            .join(side.toDF("b", "n_b", "s_b"), "b")
            .where((4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")))
            .where(passes("n_a", "s_a", "n_b", "s_b"))
            .select("a", "b")
        )

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs(a, b)`` whose sets link."""
        pairs = stored(pairs.distinct(), "pairs")
        needed = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        # one row of the class, known by its id and text: ids may repeat, and be missing
        chosen = stored(self.sketches.join(needed, "class", "left_semi").select("class", "row.*"), "needed")
        at = broadcast_if_small(chosen.toDF("class", "id", "hash"))
        same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
        texts = stored(self.docs.join(at, same).select("class", "text"), "texts").dropDuplicates(["class"])

        cached: dict[int, np.ndarray] = {}

        def test(a, b, text_a, text_b):
            if a not in cached:
                if len(cached) >= 16:
                    cached.clear()
                cached[a] = shingle_set(text_a)
            return a, b, linked(cached[a], shingle_set(text_b))

        joined = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        tested = map_rows(joined, ["a", "b", "text_a", "text_b"], test, "a long, b long, linked boolean", chunk=128)
        return stored(tested.where("linked").select("a", "b"), "linked")

    def labelled(self, blocks: DataFrame, labels: DataFrame) -> DataFrame:
        """``key, class, label`` of the keys that more than two classes have."""
        own = labels.select(F.col("node").alias("class"), F.col("component").alias("label"))
        kept = blocks.where(F.col("key").isNotNull()).select("key", "class")
        joined = kept.join(broadcast_if_small(own), "class", "left")
        return joined.select("key", "class", F.coalesce("label", "class").alias("label"))

    def open_groups(self, labelled: DataFrame) -> DataFrame:
        """Small groups' pairs and large groups' keys and rows, see ``_open_groups``."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        found = (
            labelled.repartition(parts, "key")
            .sortWithinPartitions("key", "class")
            .mapInArrow(_open_groups, "large int, a long, b long")
        )
        return stored(found.distinct(), "open")

    def within_groups(self, labelled: DataFrame, large: DataFrame, every: bool) -> DataFrame:
        """Pairs across labels of the ``large(key, rows)`` groups, see ``_ComparePieces``.

        A group is cut into pieces, and every two pieces meet in one unit of work.
        """
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        count = F.ceil(F.col("rows") / PIECE_ROWS).cast("long")
        meets = F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)
        unit = ["key", "low", "high"]
        found = (
            labelled.join(broadcast_if_small(large), "key")
            .withColumn("pieces", count)
            .withColumn("piece", F.pmod(F.xxhash64("class"), "pieces"))
            .join(self.sketches.select("class", "n", "sketch"), "class")
            .withColumn("other", F.explode(meets))
            .select(
                "key",
                F.least("piece", "other").alias("low"),
                F.greatest("piece", "other").alias("high"),
                "piece",
                "class",
                "label",
                "n",
                "sketch",
            )
            .repartition(parts, *unit)
            .sortWithinPartitions(*unit)
            .mapInArrow(_ComparePieces(every), "large int, a long, b long")
        )
        return stored(found, "compared")

    def links(self) -> DataFrame:
        """Links between classes that hold the components together."""
        blocks = self.shared_blocks()
        star = blocks.where(F.col("class") != F.col("first")).select(
            F.least("class", "first").alias("a"), F.greatest("class", "first").alias("b")
        )
        found = self.verified(self.sketched(star.distinct()))
        labelled = self.labelled(blocks, components(found))
        groups = self.open_groups(labelled)
        pairs = self.sketched(groups.where("large = 0").select("a", "b"))
        large = groups.where("large = 1").select(F.col("a").alias("key"), F.col("b").alias("rows"))
        if not large.limit(1).count():
            return found.unionByName(self.verified(pairs))
        compared = self.within_groups(labelled, large, every=False)
        found = found.unionByName(self.verified(pairs.unionByName(compared.where("large = 0").select("a", "b"))))
        again = compared.where("large = 1").select(F.col("a").alias("key")).distinct()
        if again.limit(1).count():
            # most labels of these groups are one by now
            labelled = self.labelled(blocks, components(found))
            compared = self.within_groups(labelled, large.join(again, "key", "left_semi"), every=True)
            found = found.unionByName(self.verified(compared.where("large = 0").select("a", "b")))
        return found


    def of_classes(self) -> DataFrame:
        """``class, component``: the name of the class's component."""
        joined = components(self.links()).toDF("class", "component")
        named = self.sketches.select("class", "doc_id").join(joined, "class", "left")
        return named.withColumn("component", F.coalesce("component", "class"))


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Two documents link if 100 * intersection >= 75 * union of their shingle sets;
    ``component_id`` is the smallest id reachable by links. Rows are told apart by id
    and text, so an id that repeats with another text names both.
    """
    run = JaccardJoin(docs, id_column, text_column)
    named = run.of_classes()
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(smallest, "component").select("class", "component_id")
    return run.members.join(of_class, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", F.when(F.col("class").isNull(), F.col("doc_id"))).alias("component_id")
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, of each group of like ones only one.

    That with the smallest id stays, one without an id only if none has one; of rows that
    agree in id and text the first by all columns. Rows without words are like nothing
    and all stay.
    """
    run = JaccardJoin(docs, id_column, text_column)
    rows = run.members.where(F.col("class").isNotNull()).groupBy("doc_id", "text_hash", "class").agg(F.count("*").alias("rows"))
    grouped = stored(rows.join(run.of_classes().select("class", "component"), "class"), "grouped-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    winners = grouped.groupBy("component").agg(first)
    judged = grouped.join(winners, "component").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    )
    judged = stored(judged.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "rows", "stays"), "judged-rows")
    keyed = docs.withColumn("__own", F.xxhash64(docs[text_column].cast("string")))
    same = lambda side: docs[id_column].cast("long").eqNullSafe(side["__id"]) & (keyed["__own"] == side["__hash"])
    out = broadcast_if_small(judged.where(~F.col("stays") | (F.col("rows") > 1)).select("__id", "__hash"))
    left = keyed.join(out, same(out), "left_anti").select(*docs.columns)
    twice = judged.where(F.col("stays") & (F.col("rows") > 1)).select("__id", "__hash")
    if not twice.limit(1).count():
        return left
    # equal rows are one after a partial aggregate, however many they are
    twice = broadcast_if_small(twice)
    copies = keyed.join(twice, same(twice), "left_semi")
    one = copies.groupBy(F.col(id_column).alias("__id"), "__own").agg(F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("__r"))
    return left.unionByName(one.select("__r.*"))
