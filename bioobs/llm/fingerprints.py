"""Document fingerprints from prefix polynomial hashes.

A text of code points c0, c1, ... has two prefix arrays (one per modulus)
S[i] = sum of c_j * B^j for j < i. Any span [i, i + n) hashes to
(S[i + n] - S[i]) * B^-i, which does not depend on where the span stands. So
equality of spans is one comparison, and the longest common extension of two
positions is a binary search.

The fingerprint takes the hash of every span of ``SPAN`` code points, deals them
to ``REGISTERS`` registers and keeps the smallest of each. Two fingerprints are
alike by the share of registers that agree among those that either fills, an
estimate of the share of spans the texts have in common.

Defined cases: a missing text counts as empty; an empty text fills no register,
is entirely like another empty text and entirely unlike any other; a text
shorter than a span is one span of its own length. Of several rows with one id,
the smallest text (a missing one first) is the "next document" of the id before.
A missing id orders before all others. With one id only, the next document is
that one itself. Columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bioobs.llm.common import arrow_schema, batch_of

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_116_541_427, 1_804_289_383)
SPAN = 24
REGISTERS = 64
EMPTY = np.uint64(2**64 - 1)
LOWEST_ID = -(2**63)


class _Powers:
    """B^j and B^-j for one modulus, grown when a longer text appears."""

    def __init__(self, base: int, prime: int):
        self.prime = np.uint64(prime)
        self.roots = (base, pow(base, -1, prime))
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            self.up, self.down = (
                np.concatenate([old, old * np.uint64(pow(root, size, int(self.prime))) % self.prime])
                for old, root in zip((self.up, self.down), self.roots)
            )


_POWERS = [_Powers(b, p) for b, p in zip(BASES, PRIMES)]


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str | None):
        points = np.frombuffer((text or "").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        self.length = len(points)
        self.sums = []
        for powers in _POWERS:
            powers.grow(self.length + 1)
            # terms stay below 2^31, so the running sum of 2^33 of them fits in 64 bits
            sums = np.zeros(self.length + 1, np.uint64)
            np.cumsum((points + np.uint64(1)) * powers.up[: self.length] % powers.prime, out=sums[1:])
            sums %= powers.prime
            self.sums.append(sums)

    def spans(self, size: int) -> np.ndarray:
        """Hashes of all spans of a size, by start."""
        count = self.length - size + 1
        high, low = (
            (s[size:] + p.prime - s[:count]) % p.prime * p.down[:count] % p.prime
            for s, p in zip(self.sums, _POWERS)
        )
        return high << np.uint64(31) | low

    def span(self, start: int, size: int) -> tuple[int, ...]:
        return tuple(
            (int(s[start + size]) - int(s[start])) * int(p.down[start]) % int(p.prime)
            for s, p in zip(self.sums, _POWERS)
        )

    def same(self, start: int, other: PrefixHash, other_start: int, size: int) -> bool:
        return self.span(start, size) == other.span(other_start, size)

    def common(self, start: int, other: PrefixHash, other_start: int) -> int:
        """Length of the longest common extension of two positions."""
        low, high = 0, min(self.length - start, other.length - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low


def registers(prefix: PrefixHash) -> np.ndarray:
    out = np.full(REGISTERS, EMPTY, np.uint64)
    if prefix.length:
        hashes = prefix.spans(min(SPAN, prefix.length))
        with np.errstate(over="ignore"):
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(29)
            hashes *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum.at(out, (hashes & np.uint64(REGISTERS - 1)).astype(np.intp), hashes >> np.uint64(6))
    return out


def as_text(values: np.ndarray) -> str:
    """Four hexadecimal digits per register, ``----`` where it is empty."""
    return "".join("----" if v == EMPTY else f"{int(v) & 0xFFFF:04x}" for v in values)


def likeness(one: str, other: str) -> float:
    """Agreeing registers over registers that either text fills; 1 for two empty texts."""
    pairs = [(one[i : i + 4], other[i : i + 4]) for i in range(0, len(one), 4)]
    filled = [a == b for a, b in pairs if a != "----" or b != "----"]
    return sum(filled) / len(filled) if filled else 1.0


def _edges(ids: DataFrame, parts: int) -> tuple[list[int], int | None]:
    """Ids that split the table into about equal ranges, and the smallest id.

    At most ``parts`` values reach the driver.
    """
    shares = [k / parts for k in range(1, parts)]
    found = ids.agg(
        F.percentile_approx("id", shares or [0.5], 10_000).alias("edges"), F.min("id").alias("least")
    ).first()
    if found.least is None:
        return [], None
    edges = sorted({e for e in found.edges if e > found.least}) if shares else []
    return edges, found.least


def _beside_next(docs: DataFrame, id_column: str, text_column: str, parts: int) -> DataFrame:
    """Deal rows into id ranges, each holding also the first rows of the next range.

    A range edge is an id of the table, so the rows of that id are the ones the
    range before it needs; the last range gets the rows of the smallest id. Text
    moves once.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST_ID)).alias("id"),
        F.col(text_column).alias("text"),
    )
    edges, least = _edges(rows.select("id"), parts)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(np.array(edges, dtype=np.int64), ids.to_numpy(), side="right")
        starts = set(edges)
        return pd.Series(
            [
                [int(p)] + ([int(p) - 1] if i in starts else []) + ([len(edges)] if i == least else [])
                for i, p in zip(ids.tolist(), own)
            ]
        )

    dealt = rows.select("*", F.posexplode(places("id")).alias("copy", "place"))
    guest = F.col("copy") > 0
    return (
        dealt.select("place", guest.alias("guest"), "doc_id", "id", "text")
        .repartition(parts, "place")
        .sortWithinPartitions(
            "place", F.desc("guest"), F.desc("id"), F.col("text").desc_nulls_last()
        )
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix long"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, largest id first, so the next document is the one just passed."""
    schema = arrow_schema(SCHEMA)
    place = current = None
    following = last = ("", as_text(registers(PrefixHash(""))))
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            out = []
            for own_place, guest, doc_id, ident, text in zip(
                *(c.to_pylist() for c in batch.slice(at, 256).columns)
            ):
                text = text or ""
                if own_place != place:
                    place, current = own_place, None
                if (guest, ident) != current:
                    current, following = (guest, ident), last
                prefix = PrefixHash(text)
                own = as_text(registers(prefix))
                last = (text, own)
                if guest:
                    continue
                n = len(text)
                edited = text[: n - n // 4] + following[0][: n // 4]
                changed = PrefixHash(edited)
                print_of_edit = as_text(registers(changed))
                out.append(
                    (
                        doc_id,
                        n,
                        hashlib.sha256(edited.encode()).hexdigest(),
                        own,
                        print_of_edit,
                        likeness(own, print_of_edit),
                        likeness(own, following[1]),
                        prefix.common(0, changed, 0),
                    )
                )
            yield batch_of(out, schema)


def fingerprint_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", parts: int | None = None
) -> DataFrame:
    """Fingerprint every text, its edited text, and compare with the next document.

    The edited text has its last quarter (rounded down) replaced by the first as
    many code points of the next document in ascending id, after the last the
    first. ``parts`` is the number of id ranges, by default the session's number
    of shuffle partitions.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _beside_next(docs, id_column, text_column, max(1, parts)).mapInArrow(_compare, SCHEMA)
