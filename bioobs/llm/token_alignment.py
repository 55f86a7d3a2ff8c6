"""How the tokens of two tokenizers line up over the same bytes.

The tokens of tokenizer A and of tokenizer B cut one text. Where both end at a byte,
a group ends; within groups, an A token and a B token that share bytes are linked.
Most groups hold one token of each with the same bytes, and for these an array, made
once from the vocabularies, already names the B id of an A id. Their links are counted
in a vector over A's vocabulary, by task. Only links of other groups become pairs
of ids that are counted by shuffle.

A pass over the texts stores each document's digest and links; the corpus-wide counts
come from that table and go back to it, so no text is encoded twice.

Defined cases: a text that is missing or empty, or whose A or B tokens do not spell the
text after one space, has no tokens: zeros and an empty digest. Rows are kept apart by
their own number, so repeated and missing ids give one row each. Other columns are not
read; an empty table gives no rows. A text is held whole by one task, in memory
proportional to its length.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bioobs.llm.common import arrow_schema, stored
from bioobs.operators.joins import broadcast_if_small

# fixed values: what the piece vocabulary writes for a space, and the alphabet of the byte-level vocabulary
PIECE_SPACE = "▁"
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
# fixed value: how a byte-level pre-tokenizer without options splits a text
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# texts that are encoded at a time; distinct pairs that a task gathers before it passes them on
CHUNK_BYTES, GATHERED = 1 << 20, 1 << 20
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, one_to_one binary, pairs binary, times binary"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    hidden = [b for b in range(256) if b not in PRINTED]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(hidden)}


def same_by_ranks(path: str):
    """The same tokenizer as an encoder by ranks, several times as fast; None if its file is not plain byte-level BPE.

    It is when nothing comes before or after the split, and ids ascend as merges do, so
    that the id of a token is the rank of the merge that makes it.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, before = told["model"], told["pre_tokenizer"] or {}
    plain = told["normalizer"] is None and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    plain &= before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    if not plain or any(not t["special"] for t in told["added_tokens"]):
        return None
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != list(range(256, 256 + len(merged))):
        return None
    alphabet = byte_alphabet()
    added = {t["content"] for t in told["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in entry): i for entry, i in model["vocab"].items() if entry not in added}
    return tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the B id that has the bytes of an A id (-1: none)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.quick_a = same_by_ranks(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        entries = self.a.get_vocab()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            # an added token is spelled as it is, which matters only if a text could produce it
            plain = all(c in alphabet for c in entry)
            self.bytes_a[i] = bytes(alphabet[c] for c in entry) if plain else entry.encode()
        pieces = self.b.id_to_piece(list(range(self.b.get_piece_size())))
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(PIECE_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        by_bytes: dict[bytes, int] = {}
        for i, spelled in enumerate(self.bytes_b):  # an ordinary piece goes before a byte of the fallback
            if spelled and not self.b.is_control(i) and not self.b.is_unknown(i) and (spelled not in by_bytes or self.b.is_byte(by_bytes[spelled])):
                by_bytes[spelled] = i
        self.same = np.array([by_bytes.get(x, -1) for x in self.bytes_a], np.int64)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # ids as text, followed by what may stand behind them
        self.inner_a, self.last_a = (np.array([f"{i}{c}" for i in range(len(self.bytes_a))], object) for c in ",|")
        self.inner_b, self.last_b = (np.array([f"{i}{c}" for i in range(len(self.bytes_b))], object) for c in ",;")

    def encode(self, texts: list[str]) -> tuple[list, list]:
        if self.quick_a:
            a = [self.quick_a.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        else:
            a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1, return_type="numpy")


@lru_cache(maxsize=1)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def group_text(v: Vocabularies, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, both: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3`` for all groups."""
    group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
    last_a, last_b = both[group_a] == ends_a, both[group_b] == ends_b
    out = np.empty(len(a) + len(b), object)
    # before an A token stand the B tokens of earlier groups, before a B token the A tokens up to its own
    out[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = np.where(last_a, v.last_a[a], v.inner_a[a])
    out[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = np.where(last_b, v.last_b[b], v.inner_b[b])
    return "".join(out.tolist())[:-1]


def align(v: Vocabularies, text: str, ids_a, ids_b) -> tuple | None:
    """``n_groups, n_links, digest, A ids of one-to-one groups, other pairs, their numbers``; None without tokens."""
    spelled = b" " + text.encode()
    a, b = np.asarray(ids_a, np.int64), np.asarray(ids_b, np.int64)
    if b"".join([v.bytes_a[i] for i in a.tolist()]) != spelled or b"".join([v.bytes_b[i] for i in b.tolist()]) != spelled:
        return None
    ends_a, ends_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
    ends = np.concatenate([ends_a, ends_b])
    ends.sort(kind="stable")
    repeated = ends[1:] == ends[:-1]
    both = ends[1:][repeated]
    # a link for each stretch between two neighbouring ends: one A and one B token cover it
    cuts = ends[np.concatenate([[True], ~repeated])]
    of_a, of_b = a[np.searchsorted(ends_a, cuts)], b[np.searchsorted(ends_b, cuts)]
    width = np.diff(cuts, prepend=0)
    regular = (v.length_a[of_a] == width) & (v.length_b[of_b] == width) & (v.same[of_a] == of_b)
    pairs, times = np.unique(of_a[~regular] << 32 | of_b[~regular], return_counts=True)
    digest = hashlib.sha256(group_text(v, a, b, ends_a, ends_b, both).encode()).hexdigest()
    return len(both), len(cuts), digest, of_a[regular].astype(np.uint32), pairs, times.astype(np.uint32)


def _aligned(path_a: str, path_b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    v, schema = vocabularies(path_a, path_b), arrow_schema(ALIGNED)
    nothing = (0, 0, 0, 0, "", b"", b"", b"")

    def rows(ids: list, texts: list[str]) -> pa.RecordBatch:
        out = []
        for i, t, a, b in zip(ids, texts, *v.encode(texts)):
            found = align(v, t, a, b) if t else None
            out.append((i, *nothing) if found is None else (i, len(a), len(b), *found[:3], *(x.tobytes() for x in found[3:])))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = t.as_py() or ""
            ids.append(i)
            texts.append(text)
            size += len(text) + 64
            if size >= CHUNK_BYTES:
                yield rows(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield rows(ids, texts)


def _column(batch: pa.RecordBatch, name: str, kind) -> np.ndarray:
    """The arrays packed in a column, one behind the other."""
    return np.frombuffer(b"".join(x for x in batch.column(name).to_pylist()), kind)


def _one_to_one_counts(path_a: str, path_b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    v, schema = vocabularies(path_a, path_b), arrow_schema("pair long, n long")
    counts = np.zeros(len(v.same), np.int64)
    for batch in batches:
        counts += np.bincount(_column(batch, "one_to_one", np.uint32), minlength=len(counts))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used << 32 | v.same[used]), pa.array(counts[used])], schema=schema)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("pair long, n long")

    def summed(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, at, np.concatenate(times))
        return keys, totals

    pairs, times, held = [], [], 0
    for batch in batches:
        pairs.append(_column(batch, "pairs", np.int64))
        times.append(_column(batch, "times", np.uint32).astype(np.int64))
        held += len(pairs[-1])
        if held > 2 * GATHERED:
            p, t = summed(pairs, times)
            if len(p) > GATHERED:
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(t)], schema=schema)
                p, t = p[:0], t[:0]
            pairs, times, held = [p], [t], len(p)
    if pairs:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed(pairs, times)], schema=schema)


def _one_to_one_sums(vectors, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: how many one-to-one links are the best of their B id, and the sum of their counts."""
    counts, best = vectors.value
    for batch in batches:
        lists = [np.frombuffer(x, np.uint32) for x in batch.column("one_to_one").to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        ids = np.concatenate([*lists, np.zeros(0, np.uint32)])
        sums = [np.concatenate([[0], np.cumsum(x[ids])]) for x in (best, counts)]
        columns = [c for c, f in zip(batch.columns, batch.schema) if f.name != "one_to_one"]
        columns += [pa.array(s[bounds[1:]] - s[bounds[:-1]]) for s in sums]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema(SUMMED))


SUMMED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, best_1 long, sum_1 long"


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("row long, pair long, times long")
    for batch in batches:
        sizes = np.array([len(x) // 8 for x in batch.column("pairs").to_pylist()], np.int64)
        rows = np.repeat(batch.column("row").to_numpy(zero_copy_only=False), sizes)
        pairs, times = _column(batch, "pairs", np.int64), _column(batch, "times", np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(pairs), pa.array(times)], schema=schema)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``doc_id, text``.

    Sent to the driver and to the tasks are two vectors over A's vocabulary, whatever the
    input. The counts of other pairs are joined to the documents' links; a copy of them
    goes to the tasks only after their number has been looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned = stored(
        texts.mapInArrow(partial(_aligned, path_a, path_b), ALIGNED).withColumn("row", F.monotonically_increasing_id()), "aligned"
    )
    regular = aligned.select("one_to_one").mapInArrow(partial(_one_to_one_counts, path_a, path_b), "pair long, n long")
    irregular = aligned.select("pairs", "times").where(F.octet_length("pairs") > 0).mapInArrow(_pair_counts, "pair long, n long")
    # the vectors meet by A id, at most a row for each; the pairs by both ids
    totals = regular.groupBy("pair").agg(F.sum("n").alias("n")).unionByName(irregular.groupBy("pair").agg(F.sum("n").alias("n")))
    counted = stored(totals.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    id_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    highest = counted.groupBy(id_b.alias("b")).agg(F.max("n").alias("highest"))
    judged = stored(
        counted.withColumn("b", id_b).join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "judged-pairs"
    )
    v = vocabularies(path_a, path_b)
    known = np.flatnonzero(v.same >= 0)
    same = spark.createDataFrame(pa.table({"pair": known << 32 | v.same[known]}))
    counts, best = np.zeros(len(v.same), np.int64), np.zeros(len(v.same), np.int64)
    for pair, n, top in judged.join(F.broadcast(same), "pair", "left_semi").collect():  # at most a row for each A id
        counts[pair >> 32], best[pair >> 32] = n, top
    vectors = spark.sparkContext.broadcast((counts, best))
    kept = [c.split()[0] for c in SUMMED.split(", ")[:-2]]
    base = aligned.select(*kept, "one_to_one").mapInArrow(partial(_one_to_one_sums, vectors), SUMMED)
    links = aligned.select("row", "pairs", "times").where(F.octet_length("pairs") > 0).mapInArrow(_exploded, "row long, pair long, times long")
    rest = links.join(broadcast_if_small(judged), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_n"), F.sum(F.col("times") * F.col("n")).alias("sum_n")
    )
    zero = F.lit(0).cast("long")
    return base.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best_1") + F.coalesce("best_n", zero)).alias("n_best"),
        (F.col("sum_1") + F.coalesce("sum_n", zero)).alias("count_sum"),
        "groups_sha256",
    )
