"""Quality rules: fixed base limits, then a decision list learned from labelled statistics.

Statistics of the whole text (``STATISTICS``) are counted first.  Sequential
covering then learns rules for the bad class one after the other: a rule grows
by the threshold condition with the highest information gain until it covers no
good document of the growing part, and is pruned from its end on the other part.
A rule that is not precise enough there ends the list; the documents it covers
leave before the next rule is learned.  The list is emitted as an ordered Spark
conditional expression, so it can be read, stored as SQL and run without this
module.

Learning reads the statistics of at most ``ListBounds.per_class`` labelled
documents of each class.  Defined cases: NULL is a text without words, which the
base rejects; without two classes the list is empty and everything that passes
the base is kept; statistics and verdict are columns, so no input column clashes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.llm.cluster import unused_name
from lumbung.llm.labelled import sampled_texts
from lumbung.llm.spans import BLANK, Run, column_bytes, mix, owners, slices, span_hashes, sums_by

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_same"
)
WINDOW = 5  # words
#: what conditions are about: shares of the statistics, as SQL over their names
MEASURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "same": "n_same / greatest(n_words, 1)",
}


def _members(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


SYMBOL = _members("#*$%&|<>")
UPPER = _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
MARK = _members("!?.,;:")


def statistics(text: str = "text") -> Column:
    """struct of STATISTICS of a text column, each a long."""

    @F.arrow_udf("struct<" + ", ".join(f"{name}: long" for name in STATISTICS) + ">")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in count_statistics(texts)], list(STATISTICS))

    return counted.asNondeterministic()(F.coalesce(F.col(text), F.lit("")))


def count_statistics(texts: pa.Array) -> np.ndarray:
    data, starts, ends = column_bytes(texts)
    out = np.zeros((len(STATISTICS), len(texts)), np.int64)
    for i, j in slices(starts, ends, 2 << 20):
        out[:, i:j] = _count(Run(data, starts[i:j], ends[i:j]))
    return out


def _count(run: Run) -> np.ndarray:
    first, last, counts = run.words()
    n = len(run.text)

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(n + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[run.ends] - sums[run.starts]

    prefix = run.prefix()
    words, of = span_hashes(prefix, first, last), owners(counts)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    dup_lines, lines = _lines(run, prefix)
    return np.stack(
        [
            counts,
            total(((run.text & 0xC0) != 0x80) & ~BLANK[run.text]),
            total(SYMBOL[run.text]),
            dup_lines,
            _repeated(words, of, counts),
            lines,
            total(UPPER[run.text]),
            total(MARK[run.text]),
            sums_by(counts, again),
        ]
    )


def _lines(run: Run, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their text, and all lines with a word."""
    breaks = np.flatnonzero(run.text == 0x0A)
    inner = np.searchsorted(breaks, run.ends) - np.searchsorted(breaks, run.starts)
    inner = np.maximum(inner, 0)
    of = np.repeat(np.arange(len(inner)), inner + 1)
    begin = np.empty(len(of), np.int64)
    end = np.empty(len(of), np.int64)
    head = np.cumsum(inner + 1) - (inner + 1)
    is_head = np.zeros(len(of), bool)
    is_head[head] = True
    is_tail = np.zeros(len(of), bool)
    is_tail[head + inner] = True
    begin[is_head], begin[~is_head] = run.starts, breaks + 1
    end[is_tail], end[~is_tail] = np.maximum(run.starts, run.ends), breaks
    filled = np.zeros(len(run.text) + 1, np.int64)
    np.cumsum(~BLANK[run.text], out=filled[1:])
    worded = filled[end] > filled[begin]
    begin, end, of = begin[worded], end[worded], of[worded]
    keys = mix(span_hashes(prefix, begin, end) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(keys, return_index=True)
    all_lines = np.bincount(of, minlength=len(inner))
    return all_lines - np.bincount(of[at], minlength=len(inner)), all_lines


def _repeated(words: np.ndarray, of: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words in windows of WINDOW words that the text has at least twice."""
    if len(words) < WINDOW:
        return np.zeros(len(counts), np.int64)
    begin = np.flatnonzero(of[: len(of) - WINDOW + 1] == of[WINDOW - 1 :])
    keys = of[begin].astype(np.uint64)
    for k in range(WINDOW):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + words[begin + k])
    _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    begin = begin[times[inverse] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + WINDOW, -1)
    return sums_by(counts, np.cumsum(cover[:-1]) > 0)


@dataclass(frozen=True)
class ListBounds:
    """What is learned from, and when a rule is good enough."""

    per_class: int = 2000
    precision: float = 0.97  # on the pruning part, of the bad class
    covered: int = 5  # bad documents of the pruning part
    conditions: int = 4
    thresholds: int = 60  # tried for each measure
    rules: int = 20
    seed: int = 3


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    @property
    def sql(self) -> str:
        return f"({MEASURES[self.measure]}) {'>' if self.above else '<='} {self.threshold!r}D"

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.measure] > self.threshold if self.above else table[self.measure] <= self.threshold


@dataclass(frozen=True)
class DecisionList:
    """Rules of the bad class in the order they are tried; a document that none fits is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    @property
    def sql(self) -> str:
        """The number of the first rule that fits, from 1, else NULL."""
        if not self.rules:
            return "cast(null as int)"
        tried = " ".join(f"WHEN {' AND '.join(c.sql for c in rule)} THEN {n}" for n, rule in enumerate(self.rules, 1))
        return f"CASE {tried} END"


def labelled_statistics(docs: DataFrame, labels: DataFrame, bounds: ListBounds) -> tuple[dict, np.ndarray]:
    rows = (
        sampled_texts(docs, labels, "quality", bounds.per_class)
        .select("doc_id", "label", statistics().alias("s"))
        .select("doc_id", "label", *(F.expr(_qualified(sql, "s")).alias(name) for name, sql in MEASURES.items()))
        .collect()
    )
    rows = sorted(rows)
    table = {name: np.array([row[name] for row in rows], float) for name in MEASURES}
    return table, np.array([row["label"] == 0 for row in rows], bool)


def _qualified(sql: str, column: str) -> str:
    """``sql`` over the statistics inside a struct column."""
    return re.sub("|".join(STATISTICS), lambda name: f"{column}.{name[0]}", sql)


def learn_rules(docs: DataFrame, labels: DataFrame, bounds: ListBounds = ListBounds()) -> DecisionList:
    """Learn from ``labels`` (doc_id, quality), 0 being the bad class."""
    return cover(*labelled_statistics(docs, labels, bounds), bounds)


def cover(table: dict[str, np.ndarray], bad: np.ndarray, bounds: ListBounds) -> DecisionList:
    random = np.random.default_rng(bounds.seed)
    rest = np.ones(len(bad), bool)
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < bounds.rules and (bad & rest).sum() >= 2 * bounds.covered and (~bad & rest).any():
        growing = rest & (random.random(len(bad)) < 2 / 3)
        pruning = rest & ~growing
        rule = _prune(_grow(table, bad, growing, bounds), table, bad, pruning)
        fits = _fits(rule, table)
        right, wrong = int((fits & pruning & bad).sum()), int((fits & pruning & ~bad).sum())
        if not rule or right < bounds.covered or right < bounds.precision * (right + wrong):
            break
        rules.append(rule)
        rest &= ~fits
    return DecisionList(tuple(rules))


def _fits(rule, table) -> np.ndarray:
    fits = np.ones(len(next(iter(table.values()))), bool)
    for condition in rule:
        fits &= condition.holds(table)
    return fits


def _grow(table, bad, part, bounds) -> tuple[Condition, ...]:
    rule: list[Condition] = []
    covered = part.copy()
    while len(rule) < bounds.conditions and (covered & ~bad).any():
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if not p:
            break
        before = np.log2(p / (p + n))
        best, best_gain = None, 1e-9
        for name, values in table.items():
            for threshold in _thresholds(values[covered], bounds.thresholds):
                for above in (True, False):
                    condition = Condition(name, above, threshold)
                    holds = covered & condition.holds(table)
                    right, wrong = int((holds & bad).sum()), int((holds & ~bad).sum())
                    if right:
                        gain = right * (np.log2(right / (right + wrong)) - before)
                        if gain > best_gain:
                            best, best_gain = condition, gain
        if best is None:
            break
        rule.append(best)
        covered &= best.holds(table)
    return tuple(rule)


def _thresholds(values: np.ndarray, most: int) -> list[float]:
    """Middles between neighbouring values, at most ``most`` of them and the same on every run."""
    distinct = np.unique(values)
    if len(distinct) < 2:
        return []
    at = np.unique(np.linspace(0, len(distinct) - 2, min(most, len(distinct) - 1)).astype(int))
    return [float(f"{x:.6g}") for x in (distinct[at] + distinct[at + 1]) / 2]


def _prune(rule, table, bad, part) -> tuple[Condition, ...]:
    def worth(conditions) -> float:
        fits = _fits(conditions, table) & part
        right, wrong = int((fits & bad).sum()), int((fits & ~bad).sum())
        return (right - wrong) / (right + wrong) if right + wrong else -1.0

    cuts = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(cuts, key=lambda c: (worth(c), -len(c)), default=())


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    return F.expr(f"{n_words} < 10 OR 100 * {n_repeat_words} > 20 * {n_words}")


def judged(docs: DataFrame, rules: DecisionList, column: str = "__quality") -> DataFrame:
    """``docs`` with struct ``column``: STATISTICS, base_failed, rule (number or NULL), kept."""
    found = docs.withColumn(column, statistics())
    rule = F.expr(_qualified(rules.sql, column)).cast("int")
    failed = base_failed(f"{column}.n_words", f"{column}.n_repeat_words")
    return found.withColumn(
        column,
        F.struct(
            *(F.col(f"{column}.{name}") for name in STATISTICS),
            failed.alias("base_failed"),
            rule.alias("rule"),
            (~failed & rule.isNull()).alias("kept"),
        ),
    )


def passing(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The rows of ``docs``, all columns, that pass the base limits and no rule rejects."""
    name = unused_name(docs, "quality_found")
    return judged(docs, rules, name).where(f"{name}.kept").drop(name)
