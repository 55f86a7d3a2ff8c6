"""Phrases whose words meet more often than chance, mined through FM-indexes.

The texts of a task, by language, become shards: sequences of word ids with a break
wherever a piece ends. A shard gets a bidirectional FM-index over its word ids, sorted
by the first five words only, since no longer phrase is asked for. Extending an
interval by all words to one side is one scatter through the LF mapping: rows of an
interval that share the word before them land side by side. A phrase comes out when
both its left and its right part could be extended into it.

Counts are summed across shards. A phrase that is frequent has frequent words and
frequent pairs only, so rare words are breaks, and phrases of three words and more are
listed in a second pass over the stored indexes, along pairs that are frequent in the
whole corpus. Every occurrence is counted; nothing is estimated. What shards send for
summing is packed: sorted keys of one range and their counts, a row for each range.

Defined cases: a missing text is empty; a missing lang is ``und``; a text without words
adds nothing; repeated rows count as often as they occur; only ``lang`` and ``text`` are
read; an empty table gives no rows; ties in score and frequency go to the smaller phrase.
A document is held whole by one task, so a shard is as long as the bound plus the
longest text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from bioobs.llm.common import stored
from bioobs.llm.packing import packed, unpacked
from bioobs.llm.words import mixed, span_hashes
from bioobs.operators.joins import broadcast_if_small

# fixed values: bytes that end a piece, and the bytes of capital letters
BREAKS, CAPITALS = b".,;:!?\n\x0b\x0c\r", bytes(range(65, 91))
LONGEST, SHARD_WORDS = 5, 1 << 21
# 0xFF is in no UTF-8 text
TRANSLATE = bytes.maketrans(BREAKS + CAPITALS + b"\t", b"\xff" * len(BREAKS) + CAPITALS.lower() + b" ")

SHARDS = pa.schema([("lang", pa.string()), ("size", pa.int64()), ("ids", pa.binary()), ("words", pa.binary()), ("local", pa.binary()), ("times", pa.binary())])
SHARDS_SQL = "lang string, size long, ids binary, words binary, local binary, times binary"
# words of one range of a shard
BLOCKS = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("local", pa.binary()), ("times", pa.binary())])
BLOCKS_SQL = "range long, shard long, lang string, words binary, local binary, times binary"
# frequent words (no shard), or the numbers of those that a shard has
WORDS = pa.schema([("shard", pa.int64()), ("local", pa.binary()), ("words", pa.binary()), ("lang", pa.string()), ("spelled", pa.string()), ("f", pa.int64()), ("word", pa.int64())])
WORDS_SQL = "shard long, local binary, words binary, lang string, spelled string, f long, word long"
# of a shard: its index (no range), or phrases of one range of keys with their counts
PARTS = pa.schema([("shard", pa.int64()), ("range", pa.int64()), ("index", pa.binary()), ("keys", pa.binary()), ("times", pa.binary())])
PARTS_SQL = "shard long, range long, index binary, keys binary, times binary"
# frequent pairs (no shard), or those of them that a shard has
PAIRS = pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("ids", pa.list_(pa.int64())), ("f", pa.int64())])
PAIRS_SQL = "shard long, keys binary, ids array<bigint>, f long"
COUNTS = pa.schema([("ids", pa.list_(pa.int64())), ("f", pa.int64())])
COUNTS_SQL = "ids array<bigint>, f long"
# phrases are dealt over one range of keys for so many words of the corpus
RANGE_WORDS = 1 << 20


def packed_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words))


def unpacked_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word ids of each language's texts, the words themselves, and how often each occurs; id 0 is a break."""

    class Shard:
        def __init__(self):
            self.known = defaultdict(count().__next__)
            self.known[b"\xff"]
            self.parts, self.size = [np.zeros(1, np.int32)], 0

        def add(self, text: bytes) -> int:
            words = (text.translate(TRANSLATE).replace(b"\xff", b" \xff ") + b" \xff").split(b" ")
            ids = np.fromiter(map(self.known.__getitem__, [w for w in words if w]), np.int32)
            self.parts.append(ids)
            self.size += len(ids)
            return len(ids)

    def row(lang: str, shard: Shard) -> pa.RecordBatch:
        ids = np.concatenate(shard.parts)
        ids = ids[np.concatenate([[True], (ids[1:] != 0) | (ids[:-1] != 0)])]  # one break is enough
        # frequent words get small numbers, which pack well; the break stays 0
        words, often = list(shard.known), np.bincount(ids)
        number = np.empty(len(words), np.int64)
        number[np.concatenate([[0], 1 + np.argsort(-often[1:], kind="stable")])] = np.arange(len(words))
        spelled = sorted(range(1, len(words)), key=words.__getitem__)
        columns = [[lang], [int(often[1:].sum())], [packed(number[ids])], [packed_words([words[i] for i in spelled])]]
        columns += [[packed(number[spelled])], [packed(often[spelled])]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SHARDS)], schema=SHARDS)

    open_shards: dict[str, Shard] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = open_shards.get(lang) or open_shards.setdefault(lang, Shard())
            held += shard.add((text.as_py() or "").encode())
            if held > SHARD_WORDS:  # all open shards of a task together stay within the bound
                lang = max(open_shards, key=lambda k: open_shards[k].size)
                held -= open_shards[lang].size
                yield row(lang, open_shards.pop(lang))
    for lang, shard in open_shards.items():
        yield row(lang, shard)


def _word_blocks(ranges: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each shard, dealt over ranges by their hashes."""
    for batch in batches:
        for shard, lang, words, local, times in zip(*batch.columns):
            local, times = unpacked(local.as_py()), unpacked(times.as_py())
            if not len(times):
                continue
            words = unpacked_words(words.as_py())
            ends = np.cumsum([len(w) for w in words])
            raw = np.frombuffer(b"".join(words), np.uint8)
            of = (span_hashes(raw, np.concatenate([[0], ends[:-1]]), ends) % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order], prepend=-1))
            for r in np.split(order, cuts[1:]):
                columns = [[int(of[r[0]])], [shard.as_py()], [lang.as_py()], [packed_words([words[i] for i in r])], [packed(local[r])], [packed(times[r])]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOCKS)], schema=BLOCKS)


def _frequent_words(least: int, ranges: int, blocks: pa.Table) -> pa.Table:
    """One range: words that are frequent over all shards of a language, with their numbers, and those that each shard has."""
    blocks = blocks.combine_chunks()
    langs = blocks.column("lang").to_pylist()
    number, columns = 0, [[] for _ in WORDS]
    for lang in dict.fromkeys(langs):
        own = blocks.filter(pa.array([x == lang for x in langs]))
        words = pa.array([w for x in own.column("words").to_pylist() for w in unpacked_words(x)], pa.binary()).dictionary_encode()
        of, times = words.indices.to_numpy(), [unpacked(x) for x in own.column("times").to_pylist()]
        totals = np.zeros(len(words.dictionary), np.int64)
        np.add.at(totals, of, np.concatenate(times))
        often = np.flatnonzero(totals >= least)
        numbers = np.zeros(len(totals), np.int64)
        numbers[often] = (number + np.arange(len(often))) * ranges + own.column("range")[0].as_py() + 1
        number += len(often)
        if len(often) and numbers.max() >= 1 << 32:
            raise ValueError("too many frequent words")
        for shard, local, word in zip(own.column("shard").to_pylist(), own.column("local").to_pylist(), np.split(numbers[of], np.cumsum([len(t) for t in times])[:-1])):
            if word.any():
                for c, x in zip(columns, (shard, packed(unpacked(local)[word > 0]), packed(word[word > 0]), None, None, None, None)):
                    c.append(x)
        spelled = [w.decode() for w in words.dictionary.take(pa.array(often)).to_pylist()]
        for c, x in zip(columns, ([None] * len(often),) * 3 + ([lang] * len(often), spelled, totals[often].tolist(), numbers[often].tolist())):
            c.extend(x)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, WORDS)], schema=WORDS)


class Index:
    """One direction of an FM-index over symbols 0 to ``symbols - 1``, sorted by the first ``LONGEST``."""

    def __init__(self, bwt: np.ndarray):
        self.bwt = bwt
        order = np.argsort(bwt, kind="stable")
        self.lf = np.empty(len(bwt), np.int64)
        self.lf[order] = np.arange(len(bwt))
        self.first = bwt[order]  # the first symbol of each row
        self.starts = np.concatenate([[True], self.first[1:] != self.first[:-1]]) if len(bwt) else np.zeros(0, bool)

    @staticmethod
    def transform(text: np.ndarray) -> np.ndarray:
        """The symbol before each row, rows sorted by their first five symbols, the text taken as a ring."""
        rank = symbols = text.astype(np.int64)
        for depth in (1, 2):  # ranks by one symbol give those by two, and these those by four
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -depth)
            order = np.argsort(key)
            key = key[order]
            rank = np.empty(len(text), np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        order = np.argsort(rank * (int(symbols.max()) + 1) + np.roll(symbols, 1 - LONGEST))
        return text[order - 1]

    def extended(self, low: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """All phrases one word longer to this side: interval, interval in the other direction, size, parent.

        ``other`` is where a phrase's interval starts in the other direction. Symbol 0
        extends nothing but takes its place there.
        """
        parent_of = np.full(len(self.lf), -1, np.int64)
        numbers = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(numbers)) + np.repeat(low - (np.cumsum(size) - size), size)
        parent_of[self.lf[rows]] = numbers
        edge = self.starts.copy()
        edge[1:] |= parent_of[1:] != parent_of[:-1]
        begin = np.flatnonzero(edge)
        length = np.diff(begin, append=len(parent_of))
        parent = parent_of[begin]
        begin, length, parent = (x[parent >= 0] for x in (begin, length, parent))
        # within a parent, extensions stand in the order of their symbols, here as in the other direction
        by_parent = np.argsort(parent, kind="stable")
        before = np.cumsum(length[by_parent]) - length[by_parent]
        heads = np.concatenate([[True], np.diff(parent[by_parent]) != 0]) if len(parent) else np.zeros(0, bool)
        before -= np.repeat(before[heads], np.diff(np.flatnonzero(heads), append=len(parent)))
        across = np.empty(len(parent), np.int64)
        across[by_parent] = other[parent[by_parent]] + before
        words = self.first[begin] != 0
        return begin[words], across[words], length[words], parent[words]


class Phrases:
    """Phrases of one length in a shard: their intervals in both directions and their sizes, by forward interval."""

    def __init__(self, low: np.ndarray, back: np.ndarray, size: np.ndarray):
        self.low, self.back, self.size = low, back, size

    def kept(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.low[keep], self.back[keep], self.size[keep])


def words_of(forward: Index) -> Phrases:
    """All single words; both directions have as many rows of each."""
    low = np.flatnonzero(forward.starts)
    size = np.diff(low, append=len(forward.lf))
    return Phrases(low, low.copy(), size).kept(forward.first[low] != 0)


def longer(forward: Index, backward: Index, known: Phrases) -> tuple[Phrases, np.ndarray, np.ndarray]:
    """Phrases one word longer whose two parts are both known, and the numbers of these: all but the last word, all but the first."""
    low, back, size, tail = forward.extended(known.low, known.size, known.back)
    _, low_too, _, head = backward.extended(known.back, known.size, known.low)
    _, left, right = np.intersect1d(low, low_too, assume_unique=True, return_indices=True)
    return Phrases(low, back, size).kept(left), head[right], tail[left]


def packed_keys(keys: np.ndarray) -> bytes:
    """Rows of word ids, sorted, column by column; the first as steps."""
    columns = keys.T.astype(np.uint32)
    columns[0, 1:] -= columns[0, :-1].copy()
    return packed(columns.ravel())


def unpacked_keys(data: bytes, width: int) -> np.ndarray:
    columns = unpacked(data).reshape(width, -1).astype(np.int64)
    columns[0] = np.cumsum(columns[0])
    return columns.T


def sorted_rows(keys: np.ndarray) -> np.ndarray:
    return np.lexsort(keys.T[::-1])


def dealt(shard: int, keys: np.ndarray, times: np.ndarray, ranges: int) -> pa.Table:
    """The phrases of a shard, one row for each range of keys that has any."""
    order = sorted_rows(keys)
    keys, times = keys[order], times[order]
    spread = np.zeros(len(keys), np.uint64)
    for column in keys.T:
        spread = mixed(spread + column.astype(np.uint64))
    of = (spread % np.uint64(ranges)).astype(np.int64)
    by_range = np.argsort(of, kind="stable")
    bounds = np.flatnonzero(np.diff(of[by_range], prepend=-1))
    rows = [(int(of[r[0]]), packed_keys(keys[r]), packed(times[r])) for r in np.split(by_range, bounds[1:]) if len(r)]
    columns = [[shard] * len(rows), [r[0] for r in rows], [None] * len(rows), [r[1] for r in rows], [r[2] for r in rows]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PARTS)], schema=PARTS)


def summed(parts: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the sum of their counts, and the number of the distinct row for each row."""
    keys, times = np.concatenate(parts), np.concatenate(times).astype(np.int64)
    order = sorted_rows(keys)
    fresh = np.concatenate([[True], (keys[order[1:]] != keys[order[:-1]]).any(axis=1)])
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(fresh) - 1
    starts = np.flatnonzero(fresh)
    return keys[order[starts]], np.add.reduceat(times[order], starts), number


def _indexed(ranges: int, shards: pa.Table, frequent: pa.Table) -> pa.Table:
    """The index of a shard over its frequent words, and every pair of them with its count."""
    if not len(shards) or not len(frequent):
        return PARTS.empty_table()
    ids, number = unpacked(shards.column("ids")[0].as_py()), shards.column("shard")[0].as_py()
    local, word = (np.concatenate([unpacked(x) for x in frequent.column(c).to_pylist()]).astype(np.int64) for c in ("local", "words"))
    order = np.argsort(local)
    local, word = local[order], word[order]
    dense = np.zeros(max(int(ids.max()), int(local[-1])) + 1, np.int64)
    dense[local] = np.arange(1, len(local) + 1)
    text = dense[ids]
    text = text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]
    forward = Index(Index.transform(text))
    single = words_of(forward)
    low, _, size, tail = forward.extended(single.low, single.size, single.back)
    parts = [packed(word), packed(forward.bwt), packed(Index.transform(text[::-1]))]
    index = b"".join(len(x).to_bytes(8, "little") + x for x in parts)
    own = pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip((number, None, index, None, None), PARTS)], schema=PARTS)
    pairs = np.column_stack([word[forward.first[low].astype(np.int64) - 1], word[tail]])
    return pa.concat_tables([own, dealt(number, pairs, size, ranges)]) if len(low) else own


def _frequent_pairs(least: int, blocks: pa.Table) -> pa.Table:
    """One range of keys: pairs that are frequent over all shards, and for each shard which of its own are."""
    parts = [unpacked_keys(x, 2) for x in blocks.column("keys").to_pylist()]
    keys, totals, number = summed(parts, [unpacked(x) for x in blocks.column("times").to_pylist()])
    often = totals >= least
    bounds = np.cumsum([len(p) for p in parts])[:-1]
    told = [(s, packed_keys(p[m])) for s, p, m in zip(blocks.column("shard").to_pylist(), parts, np.split(often[number], bounds)) if m.any()]
    found = [(k, int(t)) for k, t in zip(keys[often].tolist(), totals[often])]
    columns = [[s for s, _ in told] + [None] * len(found), [k for _, k in told] + [None] * len(found)]
    columns += [[None] * len(told) + [k for k, _ in found], [None] * len(told) + [t for _, t in found]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PAIRS)], schema=PAIRS)


def _longer_phrases(ranges: int, indexes: pa.Table, frequent: pa.Table) -> pa.Table:
    """Phrases of three words and more of a shard along frequent pairs, padded with zeros, and their counts."""
    if not len(indexes) or not len(frequent):
        return PARTS.empty_table()
    blob, number, parts = indexes.column("index")[0].as_py(), indexes.column("shard")[0].as_py(), []
    while blob:
        end = 8 + int.from_bytes(blob[:8], "little")
        parts.append(unpacked(blob[8:end]))
        blob = blob[end:]
    word, forward, backward = parts[0].astype(np.int64), Index(parts[1]), Index(parts[2])
    single = words_of(forward)
    low, back, size, tail = forward.extended(single.low, single.size, single.back)
    words = np.column_stack([word[forward.first[low].astype(np.int64) - 1], word[tail]])
    told = np.concatenate([unpacked_keys(x, 2) for x in frequent.column("keys").to_pylist()])
    keep = np.isin(words[:, 0] << 32 | words[:, 1], told[:, 0] << 32 | told[:, 1])
    known, words, found, times = Phrases(low, back, size).kept(keep), words[keep], [], []
    for length in range(3, LONGEST + 1):
        known, head, tail = longer(forward, backward, known)
        words = np.hstack([words[head], words[tail][:, -1:]])
        found.append(np.pad(words, ((0, 0), (0, LONGEST - length))))
        times.append(known.size)
    found = np.concatenate(found)
    return dealt(number, found, np.concatenate(times), ranges) if len(found) else PARTS.empty_table()


def _frequent_phrases(least: int, blocks: pa.Table) -> pa.Table:
    keys, totals, _ = summed([unpacked_keys(x, LONGEST) for x in blocks.column("keys").to_pylist()], [unpacked(x) for x in blocks.column("times").to_pylist()])
    often = totals >= least
    rows = [[w for w in k if w] for k in keys[often].tolist()]
    return pa.Table.from_arrays([pa.array(rows, COUNTS.field("ids").type), pa.array(totals[often])], schema=COUNTS)


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``ids, f`` of all phrases of one to five words that occur at least ``least`` times in a language, and what
    the ids stand for: ``word, lang, spelled``, with ``n``, the number of words of the language.

    Word ids are positive and stay below 2^32, or the query fails: more frequent words have no room.
    """
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("string")
    shards = stored(
        docs.select(lang.alias("lang"), text.alias("text")).mapInArrow(_shards, SHARDS_SQL)
        .withColumn("shard", F.monotonically_increasing_id()),
        "shards",
    )
    sizes = shards.groupBy("lang").agg(F.sum("size").alias("n"))  # a row for each language
    ranges = 1 + (shards.agg(F.sum("size")).first()[0] or 0) // RANGE_WORDS
    blocks = shards.select("shard", "lang", "words", "local", "times").mapInArrow(partial(_word_blocks, ranges), BLOCKS_SQL)
    numbered = stored(blocks.groupBy("range").applyInArrow(lambda t: _frequent_words(least, ranges, t), WORDS_SQL), "frequent-words")
    words = numbered.where("shard IS NULL").select("lang", "spelled", "f", "word").join(sizes, "lang")

    told = numbered.where("shard IS NOT NULL").select(F.col("shard").alias("of"), "local", "words")
    indexed = shards.select("shard", "ids").groupBy("shard").cogroup(told.groupBy("of"))
    found = stored(indexed.applyInArrow(lambda s, f: _indexed(ranges, s, f), PARTS_SQL), "phrase-index")
    blocks = found.where("index IS NULL").select("shard", "range", "keys", "times")
    pairs = stored(blocks.groupBy("range").applyInArrow(lambda t: _frequent_pairs(least, t), PAIRS_SQL), "frequent-pairs")

    indexes = found.where("index IS NOT NULL").select("shard", "index")
    in_shards = pairs.where("shard IS NOT NULL").select(F.col("shard").alias("of"), "keys")
    longer_ones = indexes.groupBy("shard").cogroup(in_shards.groupBy("of")).applyInArrow(lambda s, f: _longer_phrases(ranges, s, f), PARTS_SQL)
    longer_ones = longer_ones.select("range", "keys", "times").groupBy("range").applyInArrow(lambda t: _frequent_phrases(least, t), COUNTS_SQL)
    phrases = words.select(F.array("word").alias("ids"), "f").unionByName(pairs.where("shard IS NULL").select("ids", "f"))
    return stored(phrases.unionByName(longer_ones), "phrases"), words


def collocations(docs: DataFrame, least: int = 100, most: int = 2000) -> DataFrame:
    """The first ``most`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two to five words that occurs ``a >= least`` times scores 1000 a n / (l r),
    rounded down, at the cut that scores least. Phrases that stand inside a longer one
    each time are left out. ``rank`` orders by score, frequency and phrase.
    """
    phrases, words = phrase_counts(docs, least)
    several = phrases.where(F.size("ids") > 1).select("ids", F.col("f").alias("a"))
    cuts = several.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    parts = cuts.withColumns({"left": F.slice("ids", F.lit(1), F.col("cut")), "right": F.slice("ids", F.col("cut") + 1, F.size("ids"))})
    of_left = phrases.select(F.col("ids").alias("left"), F.col("f").alias("l"))
    of_right = phrases.select(F.col("ids").alias("right"), F.col("f").alias("r"))
    # n is that of the first word's language; decimals hold every product exactly or fail
    sized = parts.withColumn("word", F.col("ids")[0]).join(broadcast_if_small(words.select("word", "lang", "n")), "word")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.expr("CAST((CAST(1000 AS DECIMAL(4,0)) * a18 * n18) DIV (l18 * r18) AS BIGINT)")
    scored = (
        sized.join(of_left, "left").join(of_right, "right")
        .withColumns({f"{c}18": wide(c) for c in "anlr"})
        .withColumn("score", score)
    )
    lowest = scored.groupBy("ids", "lang", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    # what holds every occurrence of a phrase and one word more, on either side
    ends = [F.slice("ids", 1, F.size("ids") - 1), F.slice("ids", 2, F.size("ids") - 1)]
    around = several.where(F.size("ids") > 2).select(F.explode(F.array(*ends)).alias("ids"), "a").groupBy("ids").agg(F.max("a").alias("longest"))
    alone = lowest.join(around, "ids", "left").where(F.col("longest").isNull() | (F.col("longest") < F.col("a")))
    alone = stored(alone.select("ids", "lang", "a", "n", "m.score", "m.l", "m.r"), "scored-phrases")
    each = alone.select("ids", F.posexplode("ids").alias("place", "word")).join(broadcast_if_small(words.select("word", "spelled")), "word")
    texts = each.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("place", "spelled"))).alias("s"))
    phrase = F.array_join("s.spelled", " ")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = alone.join(texts, "ids").withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM split, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
several AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM several),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN total t ON t.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, phrase, max(a) AS longest FROM (
    SELECT lang, a, array_to_string(ws[1:k - 1], ' ') AS phrase FROM several WHERE k > 2
    UNION ALL SELECT lang, a, array_to_string(ws[2:], ' ') FROM several WHERE k > 2
  ) GROUP BY ALL
),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest LEFT JOIN around USING (lang, phrase) WHERE longest IS NULL OR longest < a
)
SELECT * FROM ranked WHERE rank <= 2000
"""
