"""Quality classifier by co-training: a view of the text and a view of the page's metadata teach each other."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textstats import basic_stats, one_row_each, sample_of_labels, with_rates

#: What the text says; a short text has at most a short text's share of anything.
CONTENT = {
    "word_length": "least(word_chars / greatest(n_words, 1), 15)",
    "repeat_share": "(n_words - n_distinct_words) / greatest(n_words, 20)",
    "symbol_share": "n_symbols / greatest(word_chars, 100)",
    "upper_share": "n_upper / greatest(word_chars, 100)",
    "mark_share": "n_marks / greatest(word_chars, 100)",
    "digit_share": "least(n_digits / greatest(word_chars, 100), 0.2)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 3)",
}
#: What is known of the page around it.
PAGE = {
    "log_chars": "ln(1 + text_chars)",
    "log_lines": "ln(1 + n_lines)",
    "log_line_chars": "ln(1 + text_chars / greatest(n_lines, 1))",
}
#: Sources and languages are dealt into so many buckets each, by a hash, however many there are.
KINDS = 256


@dataclass(frozen=True)
class View:
    """A logistic model of standardised features (and, for the page, one weight per bucket of sources and languages), calibrated."""

    mean: dict[str, float]
    weight: dict[str, float]
    kinds: dict[tuple[str, int], float]
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self) -> Column:
        """The calibrated log odds as a column expression."""
        at = F.lit(self.bias)
        for name, w in self.weight.items():
            at += F.lit(w) * (F.col(f"_s.{name}") - F.lit(self.mean[name]))
        for column in sorted({c for c, _ in self.kinds}):
            weights = F.array(*[F.lit(self.kinds.get((column, n), 0.0)) for n in range(KINDS)])
            at += F.get(weights, F.col(f"_s.{column}"))
        return F.lit(self.slope) * at + F.lit(self.shift)


@dataclass(frozen=True)
class Model:
    content: View
    page: View
    weights: tuple[float, float, float]

    def probability(self) -> Column:
        a, b, c = self.weights
        return 1 / (1 + F.exp(-(F.lit(a) * self.content.logit() + F.lit(b) * self.page.logit() + F.lit(c))))


def logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression (the last is the bias) by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([l2] * (x.shape[1] - 1) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def measured(docs: DataFrame) -> DataFrame:
    """docs as `_row`, and what the views look at as `_s`: names of docs' own columns can't clash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kind = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("") for c in ("source", "lang")}
    kind = {c: F.pmod(F.xxhash64(value), F.lit(KINDS)).cast("int").alias(c) for c, value in kind.items()}
    stats = with_rates(basic_stats(docs.select(F.struct("*").alias("_row"), text.alias("text"), *kind.values())), CONTENT | PAGE)
    return stats.select("_row", F.struct(*CONTENT, *PAGE, *kind).alias("_s"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 6000, pool_rows: int = 6000, rounds: int = 5, a_round: int = 200, sure: float = 0.97) -> Model | None:
    """Learn from at most fit_rows labelled and pool_rows unlabelled documents (label 1 is good); None without labels of both kinds.

    Each view trains on three fifths of the labelled rows. In every round each view labels the rows of the
    pool that it is surest of (at most a_round, both kinds in the proportion of the labels, at least
    `sure`), and they join the other view's training rows. The other two fifths of the labelled rows
    calibrate the views and weigh them against each other.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null")
    labelled = sample_of_labels(labels, fit_rows)
    pool = ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(pool_rows)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(pool), "doc_id", "left_semi").distinct()
    unlabelled = pool.join(F.broadcast(known), "doc_id", "left_anti").withColumn("y", F.lit(None).cast("int"))
    # At most fit_rows + pool_rows ids.
    wanted = F.broadcast(labelled.unionByName(unlabelled))
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(c for c in ("text", "source", "lang") if c in docs.columns))
    rows = measured(one_row_each(some.join(wanted, "doc_id"))).select("_row.doc_id", "_row.y", "_s.*").toPandas()
    rows = rows.sort_values(["doc_id", *CONTENT]).reset_index(drop=True)
    given = rows["y"].notna().to_numpy()
    y = rows["y"].fillna(0).to_numpy(float)
    if not given.any() or len(set(y[given])) < 2:
        return None
    fold = (rows["doc_id"].to_numpy(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(5)
    train, held = given & (fold < 3), given & (fold >= 3)
    if min(len(set(y[train])), len(set(y[held]))) < 2:
        train = held = given
    values = {c: sorted(set(rows[c].tolist())) for c in ("source", "lang")}
    columns = {"content": list(CONTENT), "page": [*PAGE, *((c, v) for c, vs in values.items() for v in vs)]}
    x, mean, scale = {}, {}, {}
    for view, names in columns.items():
        m = np.stack([rows[n].to_numpy(float) if isinstance(n, str) else (rows[n[0]] == n[1]).to_numpy(float) for n in names], axis=1)
        mean[view] = np.where([isinstance(n, str) for n in names], m.mean(0), 0.0)
        scale[view] = np.where([isinstance(n, str) for n in names], m.std(0) + 1e-9, 1.0)
        x[view] = (m - mean[view]) / scale[view]

    taught = {v: {i: y[i] for i in np.flatnonzero(train)} for v in x}
    share = float(y[train].mean())
    weights: dict[str, np.ndarray] = {}

    def train_view(view: str) -> None:
        at = np.fromiter(taught[view], int)
        weights[view] = logistic(x[view][at], np.fromiter(taught[view].values(), float), 1.0)

    def odds(view: str) -> np.ndarray:
        return np.hstack([x[view], np.ones((len(rows), 1))]) @ weights[view]

    for _ in range(rounds):
        lessons = {}
        for view, other in (("content", "page"), ("page", "content")):
            train_view(view)
            p = 1 / (1 + np.exp(-np.clip(odds(view), -30, 30)))
            free = np.array([i for i in np.flatnonzero(~given) if i not in taught[other]], int)
            good = free[np.argsort(-p[free], kind="stable")][: round(a_round * share)]
            bad = free[np.argsort(p[free], kind="stable")][: round(a_round * (1 - share))]
            lessons[other] = {i: 1.0 for i in good if p[i] >= sure} | {i: 0.0 for i in bad if p[i] <= 1 - sure}
        for view, more in lessons.items():
            taught[view] |= more
    views, calibrated = {}, []
    for view, names in columns.items():
        train_view(view)
        slope, shift = logistic(odds(view)[held][:, None], y[held], 1e-2)
        w = weights[view][:-1] / scale[view]
        plain = [n for n in names if isinstance(n, str)]
        views[view] = View(
            dict(zip(plain, mean[view].tolist(), strict=False)),
            dict(zip(plain, w.tolist(), strict=False)),
            {n: float(v) for n, v in zip(names, w, strict=True) if not isinstance(n, str)},
            float(weights[view][-1]), float(slope), float(shift),
        )
        calibrated.append(slope * odds(view) + shift)
    both = logistic(np.stack(calibrated, axis=1)[held], y[held], 1e-1)
    return Model(views["content"], views["page"], tuple(map(float, both)))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs and their probability of being good, as columns `_row` (a struct of all columns) and `score`.

    Built-in functions, without a shuffle. A null text counts as empty; a source or language that training
    did not see has no weight; without a model every document scores 1.
    """
    if model is None:
        return docs.select(F.struct("*").alias("_row"), F.lit(1.0).alias("score"))
    return measured(docs).select("_row", model.probability().alias("score"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **more: int) -> DataFrame:
    """The rows of docs that are good with at least this probability, unchanged."""
    return scored(docs, fit(docs, labels, **more)).filter(F.col("score") >= threshold).select("_row.*")


def digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, score and kept of every document."""
    judged = scored(docs, fit(docs, labels))
    return judged.select(F.col("_row.doc_id").cast("long").alias("doc_id"), "score", (F.col("score") >= threshold).alias("kept"))
