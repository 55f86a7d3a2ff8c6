"""Rule expressions compiled to one minimal deterministic byte automaton.

Expressions use literals, classes, groups, ``|`` and the quantifiers ``? * + {n}
{n,}``, over ASCII; ``(?i:...)`` folds the case of letters. They become a
nondeterministic automaton, subset construction makes that deterministic, and
partition refinement makes it minimal.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ASCII = frozenset(range(128))


@dataclass
class _Parser:
    """Recursive descent to trees: ('set', bytes), ('cat', [..]), ('alt', [..]), ('rep', tree, low, high)."""

    text: str
    at: int = 0
    fold: bool = False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        part = self.atom()
        while self.peek() and self.peek() in "?*+{":
            sign = self.take()
            if sign == "{":
                body = self.text[self.at : self.text.index("}", self.at)]
                self.at += len(body) + 1
                low, comma, high = body.partition(",")
                part = ("rep", part, int(low), (int(high) if high else None) if comma else int(low))
            else:
                part = ("rep", part, int(sign == "+"), 1 if sign == "?" else None)
        return part

    def atom(self):
        sign = self.take()
        if sign == "(":
            before = self.fold
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            inner = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.fold = before
            return inner
        if sign == "[":
            return ("set", self.members())
        return ("set", self.folded({self.code(sign)}))

    def code(self, sign: str) -> int:
        if sign != "\\":
            return ord(sign)
        kind = self.take()
        if kind == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(kind, kind))

    def members(self) -> frozenset[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while (sign := self.take()) != "]":
            low = high = self.code(sign)
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.code(self.take())
            found.update(range(low, high + 1))
        return self.folded(ASCII - found if negated else found)

    def folded(self, codes) -> frozenset[int]:
        if self.fold:
            codes = {ord(f(chr(c))) for c in codes for f in (str.lower, str.upper)}
        return frozenset(codes)


def parse(expression: str):
    parser = _Parser(expression)
    tree = parser.alternatives()
    if parser.at != len(expression):
        raise ValueError(f"unbalanced group in {expression!r}")
    return tree


def backwards(tree):
    """The tree of the reversed expression."""
    kind = tree[0]
    if kind == "cat":
        return ("cat", [backwards(t) for t in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [backwards(t) for t in tree[1]])
    if kind == "rep":
        return ("rep", backwards(tree[1]), *tree[2:])
    return tree


def shortest_end(tree):
    """The tree that accepts where the given one first accepts: an open last repetition stops at once.

    A search needs no more than that, and the automaton for it stays small.
    """
    if tree[0] == "cat" and tree[1]:
        return ("cat", [*tree[1][:-1], shortest_end(tree[1][-1])])
    if tree[0] == "rep" and tree[3] is None and tree[2]:
        return ("rep", tree[1], tree[2], tree[2])
    return tree


class _Nondeterministic:
    def __init__(self):
        self.free: list[list[int]] = []  # moves that read nothing
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """Append the tree behind ``start``; returns its last state."""
        kind = tree[0]
        if kind == "set":
            own, end = self.state(), self.state()
            self.free[start].append(own)
            self.moves[own] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.add(part, start)
        if high is None:
            loop, end = self.state(), self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
            return end
        end = self.state()
        for _ in range(high - low):
            self.free[start].append(end)
            start = self.add(part, start)
        self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``moves[state, byte]``; state 0 is the start; ``accepts[state]`` has a bit per rule."""

    moves: np.ndarray
    accepts: np.ndarray
    dead: int  # the state that nothing leaves, or -1

    def longest(self, data: bytes, start: int, step: int, limit: int) -> int | None:
        """Furthest position at which a run from ``start`` accepts, or None."""
        moves, accepts, state, found = self.moves, self.accepts, 0, None
        at = start
        while at != limit:
            state = int(moves[state, data[at if step > 0 else at - 1]])
            if state == self.dead:
                break
            at += step
            if accepts[state]:
                found = at
        return found


def compile_rules(trees: list, anywhere: bool) -> Automaton:
    """One automaton for all trees; with ``anywhere`` a match may begin at any byte."""
    nfa = _Nondeterministic()
    start = nfa.state()
    ends = {nfa.add(tree, start): 1 << k for k, tree in enumerate(trees)}
    begin = nfa.closure({start})

    # bytes that no move tells apart share a column
    patterns: dict[tuple, list[int]] = {}
    sets = [m[0] for m in nfa.moves if m]
    for byte in range(256):
        patterns.setdefault(tuple(byte in s for s in sets), []).append(byte)
    columns = list(patterns.values())

    numbers, table, todo = {begin: 0}, [], [begin]
    for states in todo:
        row = []
        for column in columns:
            reached = {nfa.moves[s][1] for s in states if nfa.moves[s] and column[0] in nfa.moves[s][0]}
            into = nfa.closure(reached) | (begin if anywhere else frozenset())
            if into not in numbers:
                numbers[into] = len(numbers)
                todo.append(into)
            row.append(numbers[into])
        table.append(row)
    accepts = np.array([sum(bit for end, bit in ends.items() if end in states) for states in todo], np.int64)
    return _minimal(np.array(table, np.int64), accepts, columns)


def _minimal(table: np.ndarray, accepts: np.ndarray, columns: list[list[int]]) -> Automaton:
    """Refine the partition by acceptance until every class moves alike."""
    classes = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        rows = np.column_stack([classes, classes[table]])
        refined = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == classes.max():
            break
        classes = refined
    first = np.unique(classes, return_index=True)[1]
    order = first[np.argsort(first != first[classes[0]], kind="stable")]  # the start's class is state 0
    renamed = np.empty(len(first), np.int64)
    renamed[classes[order]] = np.arange(len(order))
    moves = np.zeros((len(order), 256), np.int32)
    for k, column in enumerate(columns):
        moves[:, column] = renamed[classes[table[order, k]]][:, None]
    kept = accepts[order]
    dead = [s for s in range(len(order)) if not kept[s] and (moves[s] == s).all()]
    return Automaton(moves, kept, dead[0] if dead else -1)
