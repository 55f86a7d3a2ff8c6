"""Byte-level BPE: merges picked from a segment tree of pair ranks.

Within one piece of text (a match of the splitting pattern) every byte position
that starts a live token holds the rank of the pair it forms with the next
token. A segment tree keeps the smallest rank of each range, ties to the left.
A merge reads the root, walks down to the leftmost smallest leaf, joins two
tokens and updates at most three leaves: the one that vanished, the one that
grew and its left neighbour. A piece of n bytes costs O(n log n), so one very long
piece does not stall a task.

Defined cases: a missing or empty text has no tokens; rows are independent, so
repeated rows give repeated results; columns other than the two named are not
read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame, SparkSession

from bioobs.llm.common import map_rows

NO_PAIR = 1 << 60
# pieces kept with their ids per Python worker, twice, a bound on memory only
CACHED_PIECES = 400_000
CACHED_LENGTH = 48


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Token ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    rank, n = ranks.get, len(piece)
    size = 1 << max(0, n - 2).bit_length()
    tree = [NO_PAIR] * size + [rank(piece[i : i + 2], NO_PAIR) for i in range(n - 1)]
    tree += [NO_PAIR] * (2 * size - len(tree))
    for i in range(size - 1, 0, -1):
        left, right = tree[i + i], tree[i + i + 1]
        tree[i] = left if left <= right else right
    after = list(range(1, n + 2))  # start of the token behind the one at i
    before = list(range(-1, n))

    while (low := tree[1]) < NO_PAIR:
        i = 1
        while i < size:
            i += i
            if tree[i] != low:
                i += 1
        i -= size
        gone = after[i]
        follow = after[i] = after[gone]
        last = size + i
        if follow <= n:
            before[follow] = i
        if gone < n - 1:
            last = size + gone
            tree[last] = NO_PAIR
        end = after[follow] if follow < n else i + longest + 1
        tree[size + i] = rank(piece[i:end], NO_PAIR) if end - i <= longest else NO_PAIR
        first = before[i]
        if first >= 0:
            tree[size + first] = rank(piece[first:follow], NO_PAIR) if follow - first <= longest else NO_PAIR
            first += size
        else:
            first = size + i
        middle = (size + i) >> 1
        first >>= 1
        last >>= 1
        while middle:  # the paths of the three leaves soon meet
            left, right = tree[middle + middle], tree[middle + middle + 1]
            tree[middle] = left if left <= right else right
            if last != middle:
                left, right = tree[last + last], tree[last + last + 1]
                tree[last] = left if left <= right else right
                last >>= 1
            else:
                last = middle >> 1
            if first != middle:
                left, right = tree[first + first], tree[first + first + 1]
                tree[first] = left if left <= right else right
                first >>= 1
            else:
                first = middle >> 1
            middle >>= 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Encodes and decodes texts with one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def pieces(self, text: str) -> Iterator[str]:
        if len(text) < 1 << 20:
            return iter(self.split.findall(text))
        return (m.group() for m in self.split.finditer(text))

    def _ids(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", merge_piece(piece.encode(), self.ranks, self.longest)).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self.known) >= CACHED_PIECES:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def encode(self, text: str | None) -> array:
        """Ids as unsigned 32-bit integers."""
        known, new = self.known.get, self._ids
        out = array("I")
        out.frombytes(b"".join([known(p) or new(p) for p in self.pieces(text or "")]))
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


# one codec per rank file, pattern and Python worker
_CODECS: dict[tuple[str, str], Codec] = {}


def little_endian(ids: array) -> bytes:
    if array("I", [1]).tobytes()[0] != 1:
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def _shared_codec(spark: SparkSession, path: str, pattern: str):
    """A function that gives each Python worker its codec.

    The ranks (some 50,000 short byte strings, whatever the corpus) are read on
    the driver and broadcast, so executors need no file.
    """
    ranks = spark.sparkContext.broadcast(load_ranks(path))

    def codec() -> Codec:
        if (path, pattern) not in _CODECS:
            _CODECS[path, pattern] = Codec(ranks.value, pattern)
        return _CODECS[path, pattern]

    return codec


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, ids`` where ``ids`` holds little-endian unsigned 32-bit integers."""
    codec = _shared_codec(docs.sparkSession, path, pattern)

    def row(doc_id, text):
        return doc_id, little_endian(codec().encode(text))

    return map_rows(docs, [id_column, text_column], row, f"{id_column} long, ids binary")


def digest_documents(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode, decode the ids again, and give counts and digests of both."""
    codec = _shared_codec(docs.sparkSession, path, pattern)

    def row(doc_id, text):
        own = codec()
        ids = own.encode(text)
        return (
            doc_id,
            len(ids),
            hashlib.sha256(little_endian(ids)).hexdigest(),
            hashlib.sha256(own.decode(ids)).hexdigest(),
        )

    schema = f"{id_column} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(docs, [id_column, text_column], row, schema)
