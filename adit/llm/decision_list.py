"""Quality rules: a decision list learned by sequential covering.

Rules are conjunctions of thresholds on statistics of a text, each saying "reject". A rule grows
on two thirds of the labelled documents, condition by condition, by information gain, is pruned
on the other third from its end, and joins the list if it covers some of that third and is precise
enough there; documents it covers leave, and the next rule grows. Where a rule does not join, the
documents it was after are set aside and growing goes on with the others. The list becomes one ordered Spark expression, so
the verdict of every document is a plain column.

Defined results: a null text has no words and fails the base rules; repeated rows give equal
rows; without labels of both kinds the list is empty and the base rules alone decide; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm.common import table
from adit.llm.statistics import NAMES, labelled_sample, text_statistics

LABELLED = 20_000
MIN_PRECISION = 0.9
MIN_COVERED = 5
MOST_RULES = 16
MOST_CONDITIONS = 4
#: Each measure: a statistic, and the statistic it is a share of.
MEASURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "equal_next_share": ("n_equal_next", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "digit_share": ("n_digits", "word_chars"),
    "same_end_share": ("n_same_end", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "words": ("n_words", None),
}


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.measure] > self.threshold if self.above else x[self.measure] <= self.threshold

    def column(self) -> Column:
        return measure(self.measure) > self.threshold if self.above else measure(self.measure) <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def measure(name: str) -> Column:
    top, bottom = MEASURES[name]
    of = F.greatest(F.col(bottom), F.lit(1)) if bottom else F.lit(1)
    return F.col(top).cast("double") / of.cast("double")


def measures(rows: np.ndarray) -> dict[str, np.ndarray]:
    s = dict(zip(NAMES, rows.astype(float).T, strict=True))
    return {name: s[top] / (np.maximum(s[bottom], 1) if bottom else 1) for name, (top, bottom) in MEASURES.items()}


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    held = np.ones(len(next(iter(x.values()))), bool)
    for condition in rule:
        held &= condition.holds(x)
    return held


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule, here = [], np.ones(len(bad), bool)
    while len(rule) < MOST_CONDITIONS and (~bad & here).any():
        p0, n0 = (bad & here).sum(), (~bad & here).sum()
        best, gain = None, 1e-9
        for name, values in x.items():
            v, b = values[here], bad[here]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            ends = np.flatnonzero(np.diff(v) > 0)
            if not len(ends):
                continue
            p_low, n_low = np.cumsum(b)[ends], np.cumsum(~b)[ends]
            for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                g = p * (np.log2(np.maximum(p, 1e-9) / (p + n)) - np.log2(p0 / (p0 + n0)))
                at = int(np.argmax(g))
                if g[at] > gain:
                    best, gain = Condition(name, above, float((v[ends[at]] + v[ends[at] + 1]) / 2)), g[at]
        if best is None:
            break
        rule.append(best)
        here &= best.holds(x)
    return tuple(rule)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        c = covers(r, x)
        p, n = (bad & c).sum(), (~bad & c).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn_rules(rows: np.ndarray, label: np.ndarray) -> list[Rule]:
    """The decision list for statistics (columns as in ``NAMES``) and labels (0: reject)."""
    bad, x = label == 0, measures(rows)
    prune = np.arange(len(bad)) % 3 == 2
    left, growing, rules = np.ones(len(bad), bool), ~prune, []
    part = lambda mask: {k: v[mask] for k, v in x.items()}
    while len(rules) < MOST_RULES and (bad & growing).sum() >= MIN_COVERED:
        rule = _grow(part(growing), bad[growing])
        rule = _prune(rule, part(left & prune), bad[left & prune]) if rule else rule
        c = covers(rule, x) & left if rule else ~left
        if not (c & bad & growing).any():
            break
        held = c & prune
        enough = (bad & c).sum() >= MIN_COVERED and held.any()  # no rule without evidence it did not grow on
        if enough and (bad & held).sum() >= MIN_PRECISION * held.sum() and (bad & c).sum() >= MIN_PRECISION * c.sum():
            rules.append(rule)
            left &= ~c
            growing &= ~c
        else:
            growing &= ~(c & bad)  # set aside what this rule was after, and look for others
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that rejects a document, or 0."""
    out = None
    for i, rule in enumerate(rules, 1):
        held = rule[0].column()
        for condition in rule[1:]:
            held = held & condition.column()
        out = F.when(held, i) if out is None else out.when(held, i)
    return F.lit(0) if out is None else out.otherwise(0)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = LABELLED) -> list[Rule]:
    """Learn on at most ``most`` labelled documents, by hash of the id."""
    sample = labelled_sample(docs, labels, label, most)
    found = text_statistics(sample, keep="label").orderBy(F.xxhash64("doc_id"), "doc_id")
    found = np.array([[r[n] for n in NAMES] + [r["label"]] for r in found.collect()], dtype=np.int64).reshape(-1, len(NAMES) + 1)
    return learn_rules(found[:, :-1], found[:, -1])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the statistics, ``base_failed, rule, kept`` for every row."""
    stats = text_statistics(docs, id_col, text_col)
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = judged(docs, learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
