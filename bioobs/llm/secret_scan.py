"""Secret scans: all rules in one pass over a text's bytes.

The rules are compiled to one automaton over bytes (``automaton.py``). It is
walked once; where it first accepts for a rule, a reversed automaton finds where
that match begins and an anchored one how far it goes, both only over the match.
Matches of a rule are leftmost, as long as possible and do not overlap; matches
that fail a rule's length are dropped afterwards. Positions are code points.

Rules must be such that no match lies inside the not yet accepted beginning of
another match of the same rule; all rules here are.

Defined cases: a missing text counts as empty and has no spans; each row stands
for itself, so repeated rows give repeated results; columns other than the named
ones are not read by the scan and are kept unchanged by the redaction.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from bioobs.llm.automaton import Automaton, backwards, compile_rules, parse, shortest_end
from bioobs.llm.common import map_rows


@dataclass(frozen=True)
class Rule:
    """``least`` is the number of characters a match needs, or its ``part`` group if set."""

    kind: str
    expression: str
    least: int = 0
    part: int = 0


# fixed values: the three base kinds, then kinds added here
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]+", 39),
)
BASE_KINDS = 3


class Scanner:
    def __init__(self, rules: tuple[Rule, ...], search: Automaton, onward: list[Automaton], back: list[Automaton]):
        self.rules, self.onward, self.back = rules, onward, back
        self.parts = [re.compile(r.expression) for r in rules]
        # bytes that move all states alike share a column; a state is the list of its
        # successors, with the rules it accepts at the end
        columns, self.column_of = np.unique(search.moves, axis=1, return_inverse=True)
        self.column_of = bytes(self.column_of.reshape(-1).tolist())
        states = [[0] * columns.shape[1] + [int(mask)] for mask in search.accepts]
        for state, row in zip(states, columns):
            state[:-1] = [states[t] for t in row]
        self.start = states[0]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` in code points, by start and then rule."""
        data = text.encode()
        state = self.start
        done = [0] * len(self.rules)
        found = []
        for at, column in enumerate(data.translate(self.column_of)):
            state = state[column]
            if mask := state[-1]:
                for k, end in enumerate(done):
                    if mask >> k & 1 and at >= end:
                        begin = self.back[k].longest(data, at + 1, -1, end)
                        if begin is not None:
                            done[k] = self.onward[k].longest(data, begin, 1, len(data))
                            found.append((begin, k, done[k]))
        found = sorted(s for s in found if self._long_enough(data, *s))
        return found if len(data) == len(text) else _code_points(data, found)

    def _long_enough(self, data: bytes, begin: int, k: int, end: int) -> bool:
        rule = self.rules[k]
        if not rule.least:
            return True
        match = self.parts[k].fullmatch(data[begin:end].decode())
        return len(match.group(rule.part)) >= rule.least


def _code_points(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte positions as code points, reading the text once."""
    places, at, count = {}, 0, 0
    for byte in sorted({p for s in found for p in (s[0], s[2])}):
        count += len(data[at:byte].decode())
        at = byte
        places[byte] = count
    return [(places[b], k, places[e]) for b, k, e in found]


def build_scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    trees = [parse(r.expression) for r in rules]
    return Scanner(
        rules,
        compile_rules([shortest_end(t) for t in trees], anywhere=True),
        [compile_rules([t], anywhere=False) for t in trees],
        [compile_rules([backwards(t)], anywhere=False) for t in trees],
    )


# one scanner per set of rules and Python worker
_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}


def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _SCANNERS:
        _SCANNERS[rules] = build_scanner(rules)
    return _SCANNERS[rules]


def _joined(spans, rules) -> str:
    return ",".join(f"{rules[k].kind}:{b}:{e}" for b, k, e in spans)


def scan_documents(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, a count per base kind, the digest of the base spans, and all spans."""
    def row(doc_id, text):
        spans = _scanner(rules).spans(text or "")
        base = [s for s in spans if s[1] < BASE_KINDS]
        counts = [sum(k == kind for _, k, _ in base) for kind in range(BASE_KINDS)]
        digest = hashlib.sha256(_joined(base, rules).encode()).hexdigest()
        return (doc_id, *counts, digest, _joined(spans, rules))

    counted = ", ".join(f"n_{r.kind} long" for r in rules[:BASE_KINDS])
    schema = f"{id_column} long, {counted}, base_sha256 string, spans string"
    return map_rows(docs, [id_column, text_column], row, schema)


def redacted(text: str, spans, rules) -> str:
    """Each secret becomes ``[kind]``; overlapping ones become that of the first."""
    out, at = [], 0
    for begin, k, end in spans:
        if begin >= at:
            out += [text[at:begin], f"[{rules[k].kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """The same rows and columns with secrets replaced by ``[kind]``."""
    @F.udf(T.StringType(), useArrow=True)
    def clean(text):
        if not text:
            return text
        return redacted(text, _scanner(rules).spans(text), rules)

    return docs.withColumn(text_column, clean(docs[text_column]))
