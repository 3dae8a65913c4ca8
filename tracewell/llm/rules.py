"""Quality rules: decision lists learned by sequential covering, applied as ordered Spark conditions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_texts
from .textstats import basic_stats, one_row_each, RATES, repeated_words, sample_of_labels, with_rates

#: What a rule may ask about.
FEATURES = {**RATES, "repeat_rate": "n_repeat_words / greatest(n_words, 1)"}

Row = tuple[float, ...]
Literal = tuple[str, str, float]  # feature, <= or >, threshold


@dataclass(frozen=True)
class Rule:
    """If all conditions hold, the text is bad."""

    conditions: tuple[Literal, ...]

    def sql(self) -> str:
        return " and ".join(f"{f} {op} {t!r}D" for f, op, t in self.conditions)


def literal_masks(rows: list[Row], names: list[str], thresholds: int) -> dict[Literal, int]:
    """For every threshold condition, the rows that meet it, as bits of an integer."""
    masks: dict[Literal, int] = {}
    for k, name in enumerate(names):
        order = sorted(range(len(rows)), key=lambda i: rows[i][k])
        everything, below, at = (1 << len(rows)) - 1, 0, 0
        cuts = sorted({rows[order[(len(order) - 1) * q // thresholds]][k] for q in range(thresholds)})
        for cut in cuts:
            while at < len(order) and rows[order[at]][k] <= cut:
                below |= 1 << order[at]
                at += 1
            masks[name, "<=", cut] = below
            masks[name, ">", cut] = everything ^ below
    return masks


def learn(rows: list[Row], bad: list[bool], names: list[str], thresholds: int = 64, longest: int = 4, precision: float = 0.95, most_rules: int = 24) -> list[Rule]:
    """Sequential covering: grow a conjunction on two thirds of the rows, prune it on the others, take what it covers away.

    A rule grows by the condition with the largest information gain until it covers good rows no more, and
    is cut back to the beginning with the best balance of bad and good rows on the pruning part. It counts
    only if at least `precision` of what it covers in either part is bad; else the next one has to begin
    otherwise. The list ends when no beginning is left. Rows are in any order that has nothing to do with their labels.
    """
    if not rows:
        return []
    masks = literal_masks(rows, names, thresholds)
    grow = sum(1 << i for i in range(len(rows)) if i % 3)
    prune = ((1 << len(rows)) - 1) ^ grow
    is_bad = sum(1 << i for i, b in enumerate(bad) if b)
    left, rules, failed = (1 << len(rows)) - 1, [], set()

    def counts(mask: int) -> tuple[int, int]:
        return (mask & is_bad).bit_count(), (mask & ~is_bad).bit_count()

    while len(rules) < most_rules and counts(left & grow)[0] > 1:
        chosen: list[Literal] = []
        covered = left
        while len(chosen) < longest:
            p0, n0 = counts(covered & grow)
            if not n0:
                break
            best, gain = None, 0.0
            for literal, mask in masks.items():
                if not chosen and literal in failed:
                    continue
                p, n = counts(covered & mask & grow)
                if p and (g := p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))) > gain:
                    best, gain = literal, g
            if best is None:
                break
            chosen.append(best)
            covered &= masks[best]
        options = []
        for k in range(1, len(chosen) + 1):
            covered = left
            for literal in chosen[:k]:
                covered &= masks[literal]
            p, n = counts(covered & prune)
            options.append(((p - n) / (p + n + 1), -k, covered))
        if not options:
            break
        _, k, covered = max(options)
        (p, n), (q, m) = counts(covered & prune), counts(covered & grow)
        if not p or p < precision * (p + n) or q < precision * (q + m):
            failed.add(chosen[0])
            continue
        rules.append(Rule(tuple(chosen[:-k])))
        left &= ~covered
        failed.clear()
    return rules


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the features of every text; a null text has no words."""
    texts = doc_texts(docs).withColumn("text", F.coalesce("text", F.lit("")))
    return with_rates(repeated_words(basic_stats(texts)), FEATURES)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 6000) -> list[Rule]:
    """Rules from at most fit_rows labelled documents (label 0 is bad), in an order given by a hash. Without labels there are none."""
    sample = sample_of_labels(labels, fit_rows)
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # at most fit_rows ids
    order = ["y", "doc_id", *FEATURES]
    found = statistics(one_row_each(some.select("doc_id", "text"))).join(F.broadcast(sample), "doc_id").select(*order).collect()
    found.sort(key=lambda r: ((r["doc_id"] * 0x9E3779B97F4A7C15) % 2**64, *r[2:]))
    return learn([tuple(r[2:]) for r in found], [r["y"] == 0 for r in found], list(FEATURES))


def verdict(rules: list[Rule]) -> Column:
    """True if no rule fires; the first that does decides."""
    if not rules:
        return F.lit(True)
    cases = " ".join(f"when {r.sql()} then false" for r in rules)
    return F.expr(f"case {cases} else true end")


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the counts, base_failed and kept, for every document, in built-in functions only and without a shuffle.

    base_failed: fewer than 20 words, or over 30 of 100 words in repeated windows. Rows that repeat a doc_id,
    or have none, are documents of their own. Other columns are ignored.
    """
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return statistics(docs).select(*columns, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))


