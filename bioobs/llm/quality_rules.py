"""Quality rules: a decision list learned from labelled documents.

Statistics of each whole text are computed once. On a bounded sample of labelled
documents, sequential covering learns rules that reject: a rule grows by the
threshold condition with the largest information gain until it covers no good
document (or ``MOST_CONDITIONS``), is pruned from its end on documents held out
from growing, and is kept if it is precise there; what it covers is set aside and
the next rule is learned. The list becomes one ordered ``CASE WHEN`` expression over
the statistics, so judging is plain Spark.

Defined cases: a missing text counts as empty; it has no words and so fails the base
rule; ratios with an empty denominator are 0. Without labels, or with labels of one
kind, the list is empty and the base rule decides alone. A document labelled more
than once takes its lowest label; labels without a document are ignored. Repeated rows are judged alike. A
statistic replaces a column of its name in ``with_statistics``; ``judged`` returns
statistics and verdicts only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from bioobs.llm.common import map_rows
from bioobs.llm.words import span_hashes, window_hashes, word_bounds

# the classifier's documented bound: labelled documents it learns from
SAMPLE = 20_000
MOST_RULES = 12
MOST_CONDITIONS = 4
CUTS = 48
LEAST_COVERED = 4
LEAST_PRECISION = 0.95

SYMBOLS = "#*$%&|<>"
_SYMBOL = [ord(c) for c in SYMBOLS]
_LINE_WORD = re.compile(r"[^\x20\x09-\x0D]")

COUNTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_digits",
    "n_exclaim",
    "n_distinct_words",
]
COUNT_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends = word_bounds(raw)
    hashes = span_hashes(raw, starts, ends)
    by_byte = np.bincount(raw, minlength=256)
    later_bytes = int(by_byte[0x80:0xC0].sum())  # of one code point
    lines = [line for line in text.split("\n") if _LINE_WORD.search(line)]
    return (
        len(hashes),
        len(raw) - int(by_byte[9:14].sum() + by_byte[32]) - later_bytes,
        int(by_byte[_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        len(lines),
        int(by_byte[65:91].sum()),
        int(by_byte[97:123].sum()),
        int(by_byte[48:58].sum()),
        int(by_byte[33]),
        len(np.unique(hashes)),
    )


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a window of three words which the text has twice or more."""
    windows = window_hashes(hashes, 3)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(len(hashes), bool)
    for k in range(3):
        inside[k : k + len(windows)] |= again
    return int(inside.sum())


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


# statistics that rules may test, as columns over the counts
FEATURES: dict[str, Column] = {}


def features() -> dict[str, Column]:
    if not FEATURES:
        FEATURES.update(
            mean_word=_ratio("word_chars", "n_words"),
            symbol_ratio=_ratio("n_symbols", "word_chars"),
            dup_line_ratio=_ratio("n_dup_lines", "n_lines"),
            repeat_ratio=_ratio("n_repeat_words", "n_words"),
            upper_ratio=_ratio("n_upper", "word_chars"),
            lower_ratio=_ratio("n_lower", "word_chars"),
            digit_ratio=_ratio("n_digits", "word_chars"),
            exclaim_ratio=_ratio("n_exclaim", "n_words"),
            distinct_ratio=_ratio("n_distinct_words", "n_words"),
            line_words=_ratio("n_words", "n_lines"),
        )
    return FEATURES


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        values = rows[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, rows: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    for condition in rule:
        among = among & condition.holds(rows)
    return among


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray) -> Rule:
    """Add conditions by largest gain until no good document is covered."""
    rule: Rule = ()
    covered = among
    while len(rule) < MOST_CONDITIONS and (covered & ~bad).any():
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        start = np.log2(p / (p + n)) if p else -np.inf
        best = (0.0, None)
        for name, values in rows.items():
            cuts = np.unique(np.quantile(values[covered], np.linspace(0, 1, CUTS), method="lower"))
            for cut, after in zip(cuts[:-1], cuts[1:]):
                low = covered & (values <= cut)
                p_low, n_low = int((low & bad).sum()), int((low & ~bad).sum())
                for above, p_in, n_in in ((False, p_low, n_low), (True, p - p_low, n - n_low)):
                    if p_in < LEAST_COVERED:
                        continue
                    gain = p_in * (np.log2(p_in / (p_in + n_in)) - start)
                    if gain > best[0]:
                        best = (gain, Condition(name, above, float((cut + after) / 2)))
        if best[1] is None:
            break
        rule += (best[1],)
        covered = covered & best[1].holds(rows)
    return rule


def _worth(rule: Rule, rows, bad, among) -> tuple[float, int]:
    covered = _covers(rule, rows, among)
    p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
    return ((p - n) / (p + n) if p + n else -1.0), p


def learn(rows: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that reject; every third row is held out for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    held_out = np.arange(len(bad)) % 3 == 2
    while len(rules) < MOST_RULES and (left & bad & ~held_out).sum() >= LEAST_COVERED:
        grown = _grow(rows, bad, left & ~held_out)
        if not grown:
            break
        # the shortest beginning of the rule that does best on the held-out rows
        worth = [(_worth(grown[:k], rows, bad, left & held_out), -k) for k in range(1, len(grown) + 1)]
        (value, covered), k = max(worth)
        rule = grown[:-k]
        if covered < 1 or (value + 1) / 2 < LEAST_PRECISION:
            break
        rules.append(rule)
        left &= ~_covers(rule, rows, left)
    return rules


def with_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every whole text."""
    return map_rows(
        docs, [id_column, text_column], lambda doc_id, text: (doc_id, *text_counts(text)), f"{id_column} long, {COUNT_SCHEMA}"
    )


def learn_rules(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE
) -> list[Rule]:
    """Rules from at most ``sample`` labelled documents, chosen by a hash of their ids."""
    one = labels.where(F.col("quality").isNotNull()).groupBy(id_column).agg(F.min("quality").alias("quality"))
    chosen = one.orderBy(F.xxhash64(id_column), id_column).limit(sample)
    known = docs.select(id_column, text_column).join(F.broadcast(chosen.select(id_column)), id_column, "left_semi")
    counted = with_counts(known, id_column, text_column).where(~base_failed())
    columns = [c.alias(name) for name, c in features().items()]
    table = (
        counted.select(id_column, *columns)
        .join(F.broadcast(chosen), id_column)
        .orderBy(F.xxhash64(id_column), id_column, *features())
        .limit(sample)
        .toPandas()
    )
    rows = {name: table[name].to_numpy(float) for name in features()}
    return learn(rows, (table["quality"] == 0).to_numpy(bool))


def verdict(rules: list[Rule]) -> Column:
    """TRUE keeps: the base rule first, then the learned rules in their order."""
    case = F.when(base_failed(), F.lit(False))
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        case = case.when(holds, F.lit(False))
    return case.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, the five counts of the contract, ``base_failed``, ``kept``."""
    rules = learn_rules(docs, labels, id_column, text_column)
    return with_counts(docs, id_column, text_column).select(
        id_column, *COUNTS[:5], base_failed().alias("base_failed"), verdict(rules).alias("kept")
    )


def kept_documents(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that the list keeps, all columns unchanged.

    Counts are added beside the row, so texts are not moved.
    """
    rules = learn_rules(docs, labels, id_column, text_column)
    columns = docs.columns

    @F.pandas_udf(f"struct<{COUNT_SCHEMA.replace(' long', ':long')}>")
    def counts(texts):
        import pandas as pd

        return pd.DataFrame([text_counts(t) for t in texts], columns=COUNTS)

    packed = docs.select(F.struct(*[docs[c] for c in columns]).alias("__row"), counts(docs[text_column]).alias("__counts"))
    kept = packed.select("__row", "__counts.*").where(verdict(rules)).select("__row.*")
    return kept
