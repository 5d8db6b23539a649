"""Document quality by a regularised quadratic discriminant.

A text becomes a few statistics of its characters, words and lines, each on a
logarithmic scale. Each class has a normal distribution over them. Its covariance
is drawn towards that of both classes and towards a diagonal, so it is never
singular. The score is the logistic of the difference of the two log densities,
from Mahalanobis distances by Cholesky factors computed once, plus the log of the
classes' shares.

Statistics are computed in tasks, over whole texts; the fit uses a bounded number
of labelled rows.

Cases: null and blank texts have all statistics zero and are scored like any
other. Without training rows of both classes every score is the smoothed share
of ones. Repeated rows are scored one by one. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockglass.llm.common import held_out
from stockglass.llm.labelled import training_documents, training_labels

FOLDS, FOLD = 3, 1
TRAIN_ROWS = 20_000  # labelled rows the model is fitted to, at most
STEADY = 20  # words added to a text's length, so that rates of short texts stay moderate
TO_BOTH = 0.3  # weight of the covariance of both classes
TO_DIAGONAL = 0.02  # weight of the diagonal
FLOOR = 1e-3  # least variance, of statistics with deviation 1

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "shout": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+=<>@^_~{}[]\\/",
    "stop": b".",
    "comma": b",;:",
    "line": b"\n",
}
STATISTICS = (
    "words", "word_length", *_CLASSES,
    "distinct", "repeats", "commonest", "short", "same_lines", "longest_line",
)


def statistics(text: str | None) -> np.ndarray:
    """The statistics of a text, in the order of ``STATISTICS``."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.zeros(len(STATISTICS))
    octets = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    counts = [octets[list(members)].sum() for members in _CLASSES.values()]
    seen = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    length = sum(map(len, words))
    per_word = [
        *counts,
        sum(map(eq, words, words[1:])),
        max(seen.values()) - 1,
        sum(k for w, k in seen.items() if len(w) <= 3),
        len(lines) - len(set(lines)),
    ]
    rates = np.log1p(100 * np.array(per_word) / (n + STEADY)).tolist()
    of_classes, of_words = rates[: len(counts)], rates[len(counts) :]
    word_length = np.log((length + 5 * STEADY) / (n + STEADY))
    distinct = np.log((len(seen) + STEADY) / (n + STEADY))
    longest = np.log1p(max(map(len, lines)))
    return np.array([np.log1p(n), word_length, *of_classes, distinct, *of_words, longest])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([statistics(t).tolist() for t in batch])


@dataclass
class QuadraticDiscriminant:
    prior: float  # log odds of class 1
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray  # 2 x statistics; empty if there was only one class
    inverses: np.ndarray  # 2 inverse Cholesky factors
    log_roots: np.ndarray  # 2 halves of log determinants

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of class 1; a row holds a text's statistics."""
        odds = np.full(len(rows), self.prior)
        if len(self.means):
            z = (rows - self.centre) / self.scale
            density = []
            for mean, inverse, root in zip(self.means, self.inverses, self.log_roots):
                distance = (((z - mean) @ inverse.T) ** 2).sum(axis=1)
                density.append(-0.5 * distance - root)
            odds = odds + density[1] - density[0]
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit(rows: np.ndarray, labels: np.ndarray) -> QuadraticDiscriminant:
    n, ones = len(labels), int(labels.sum())
    share = (ones + 0.5) / (n + 1)
    prior = float(np.log(share / (1 - share)))
    size = len(STATISTICS)
    if not 0 < ones < n:
        none = np.empty((0, size))
        return QuadraticDiscriminant(prior, np.zeros(size), np.ones(size), none, none, none)
    centre, scale = rows.mean(axis=0), rows.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (rows - centre) / scale
    parts = [z[labels == k] for k in (0, 1)]
    means = np.stack([p.mean(axis=0) for p in parts])
    own = [(p - m).T @ (p - m) for p, m in zip(parts, means)]
    both = sum(own) / n
    inverses, roots = [], []
    for scatter, part in zip(own, parts):
        # A class of few rows leans more on both.
        lean = TO_BOTH + (1 - TO_BOTH) * size / (size + len(part))
        covariance = (1 - lean) * scatter / len(part) + lean * both
        diagonal = np.diag(np.diag(covariance))
        covariance = (1 - TO_DIAGONAL) * covariance + TO_DIAGONAL * diagonal + FLOOR * np.eye(size)
        factor = np.linalg.cholesky(covariance)
        inverses.append(np.linalg.inv(factor))
        roots.append(np.log(np.diag(factor)).sum())
    return QuadraticDiscriminant(prior, centre, scale, means, np.stack(inverses), np.array(roots))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QuadraticDiscriminant:
    """labels: doc_id, quality. Learns from labelled rows outside the held-out fold."""
    chosen = training_labels(labels, "quality", FOLDS, FOLD, rows)
    sample = training_documents(docs, chosen).select("label", _statistics("text").alias("x")).collect()
    sample.sort(key=lambda r: (r.x, r.label))
    table = np.array([r.x for r in sample], dtype=float).reshape(-1, len(STATISTICS))
    return fit(table, np.array([r.label for r in sample], dtype=int))


def score(docs: DataFrame, model: QuadraticDiscriminant) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per document."""

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            table = np.array([statistics(t) for t in batch]).reshape(-1, len(STATISTICS))
            yield pd.Series(model.scores(table))

    held = held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out")
    rows = docs.select("doc_id", held, scored("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    return score(docs, train(docs, labels, rows))
