"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams, trained by FTRL with elastic net, calibrated by temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows
from .textstats import one_row_each

#: Characters of the n-grams, and the buckets that they are hashed to.
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
#: ASCII that is not a letter counts as a space.
_FOLD = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)


def n_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's character n-grams, in order, and how often each occurs."""
    u = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    u = np.where(u < 128, _FOLD[np.minimum(u, 127)], u).astype(np.uint32)
    found = []
    for order in ORDERS:
        if len(u) >= order:
            h = np.full(len(u) - order + 1, order, np.uint32)
            for k in range(order):
                h = (h ^ u[k : len(u) - order + 1 + k]) * _FACTORS[k]
                h ^= h >> np.uint32(15)
            found.append(h & np.uint32(BUCKETS - 1))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def tf_idf(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[at]
    return x / (np.sqrt(x @ x) or 1.0)


@dataclass
class Ftrl:
    """Follow the regularised leader, per coordinate: squared and absolute penalties on every weight but the biases."""

    classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    def __post_init__(self) -> None:
        self.z = np.zeros((self.classes, BUCKETS + 1))
        self.n = np.zeros((self.classes, BUCKETS + 1))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, free = self.z[:, at], np.where(np.arange(BUCKETS + 1)[at] == BUCKETS, 0.0, 1.0)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1 * free, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[:, at])) / self.alpha + self.l2 * free)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        at, x = np.append(at, BUCKETS), np.append(x, 1.0)
        w = self.weights(at)
        g = np.outer(softmax(w @ x) - (np.arange(self.classes) == y), x)
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] = n + g * g


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max())
    return e / e.sum()


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return "und", 0.0
        at, counts = n_grams(text)
        p = softmax((self.weights[:, at] @ tf_idf(at, counts, self.idf) + self.weights[:, BUCKETS]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def held_out() -> Column:
    """Documents that are never learned from; so are those without a doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 4 == 2, F.lit(True))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each bucket occurs, and the number of texts."""

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for (text,) in rows:
            df[n_grams(text)[0]] += 1
            n += 1
        at = np.flatnonzero(df)
        yield from zip(at.tolist(), df[at].tolist(), strict=True)
        yield BUCKETS, n

    df = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in map_rows(texts.select("text"), rows, "bucket int, n long", 65536).groupBy("bucket").agg(F.sum("n")).collect():  # at most BUCKETS + 1 rows
        df[bucket] = n
    return df[:BUCKETS], int(df[BUCKETS])


def fit(docs: DataFrame, fit_rows: int = 800, most_languages: int = 256, epochs: int = 4) -> Model:
    """Learn from docs (doc_id, text, lang, none of them null).

    Document frequencies cover all of docs. The weights are fitted on about fit_rows documents of each
    language, taken by a hash of doc_id; every fifth of them is kept for the temperature. A language is
    learned if it is among the most_languages most frequent ones, which bounds the model (a weight per
    language and bucket); rarer ones are never predicted. Of rows that repeat a doc_id one counts.
    """
    sizes = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS + 1)), np.zeros(BUCKETS), 1.0)
    df, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1
    spread = 1 << 30
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(spread, spread * fit_rows // r["count"]))).otherwise(share)
    chosen = docs.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(spread))).filter(F.col("place") < share)
    chosen = one_row_each(chosen.select("doc_id", "place", "lang", "text"))

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for place, lang, text in rows:
            at, counts = n_grams(text)
            yield place, lang, at.astype("<i4").tobytes(), counts.astype("<i4").tobytes()

    found = map_rows(chosen.select("place", "lang", "text"), rows, "place long, lang string, at binary, counts binary", 64)
    found = found.collect()  # about fit_rows of each language
    found.sort(key=lambda r: (r["place"] * 0x9E3779B1 % spread, r["lang"], r["at"], r["counts"]))
    examples = []
    for r in found:
        at = np.frombuffer(r["at"], "<i4").astype(np.int64)
        examples.append((r["place"] % 5 == 0, languages.index(r["lang"]), at, tf_idf(at, np.frombuffer(r["counts"], "<i4"), idf)))
    ftrl = Ftrl(len(languages))
    for _ in range(epochs):
        for kept_back, y, at, x in examples:
            if not kept_back:
                ftrl.learn(at, x, y)
    weights = ftrl.weights(slice(None)).astype(np.float32)
    scores = [(weights[:, at] @ x + weights[:, BUCKETS], y) for kept_back, y, at, x in examples if kept_back]
    return Model(languages, weights, idf.astype(np.float32), temperature(scores))


def temperature(scores: list[tuple[np.ndarray, int]]) -> float:
    """What scores are divided by so that the labels are likeliest: golden-section search over its logarithm.

    One label in all is taken to be wrong, so that a sample without errors doesn't make every prediction certain.
    """
    if not scores:
        return 1.0

    wrong = 1 / (len(scores) + 1)

    def loss(log_t: float) -> float:
        logs = [(np.log(softmax(s / np.exp(log_t)) + 1e-300), y) for s, y in scores]
        return -sum(float((1 - wrong) * p[y] + wrong * p.mean()) for p, y in logs)

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(30):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each row of docs (doc_id, text); und and 0 for a text that is null or has no letter.

    A map, without a shuffle; whole texts. Rows that repeat a doc_id, or have none, are predicted like any
    other. Other columns, and lang and source above all, are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most most_languages times BUCKETS weights

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        model = shared.value
        for doc_id, text, held in rows:
            yield doc_id, held, *model.predict(text)

    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    return map_rows(ready, rows, "doc_id long, held_out boolean, lang_pred string, score double")


def digest(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict all."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return identified(docs, fit(known.filter(~held_out()).dropna()))
