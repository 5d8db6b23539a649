"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its words and their first three, four and five letters,
each a 32-bit hash, present or not. The model is linear in the terms and in all pairs of
terms; the weight of a pair is the inner product of two short vectors, so pairs
that matter together are learned even where each is harmless alone:

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>  =  w0 + sum w + (|sum v|^2 - sum |v|^2) / 2

Terms are counted by class on Spark over the training rows. Kept are the terms that
tell most on their own, and beside them the most frequent ones whatever they tell:
a word may matter only together with another. The machine is fitted on the driver to a
bounded number of labelled rows, some at a time.

Cases: a null or blank text has no terms and the score of ``w0``; very long texts are
read whole, word by word. Without
training rows of both classes every score is the smoothed share of ones. Repeated
rows are scored one by one. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockglass.llm.common import held_out, materialize
from stockglass.llm.labelled import training_documents, training_labels

FOLDS, FOLD = 5, 0
TRAIN_ROWS = 20_000  # labelled rows the model is fitted to, at most
TERMS = 4096  # terms kept for what they tell on their own, at most
LEAST_GAIN = 8.0  # log-likelihood ratio (G squared) such a term reaches
FREQUENT = 512  # most frequent terms, kept for what they may tell together
AT_A_TIME = 1000  # rows whose slopes are computed together
FACTORS = 4
EPOCHS = 60
L2 = 1e-5  # penalty on all weights
PREFIXES = (3, 4, 5)
CACHED_WORDS = 200_000  # words whose terms a task remembers at a time
CACHED_LENGTH = 64
_EDGES = ".,;:!?\"'()[]{}<>*#%&$|~`_-"


def word_terms(word: str) -> tuple[int, ...]:
    """Hashes of a lower-case word and its beginnings."""
    word = word.strip(_EDGES)
    if not word:
        return ()
    terms = ["w" + word] + [f"{n}{word[:n]}" for n in PREFIXES if len(word) > n]
    return tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in terms)


def term_finder(pick: Callable[[str], tuple[int, ...]]) -> Callable[[str | None], set[int]]:
    """A function from a text to the set of what ``pick`` gives for its words."""
    known: dict[str, tuple[int, ...]] = {}

    def find(text: str | None) -> set[int]:
        found: set[int] = set()
        for word in set((text or "").lower().split()):
            terms = known.get(word)
            if terms is None:
                terms = pick(word)
                if len(word) <= CACHED_LENGTH:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    known[word] = terms
            if terms:
                found.update(terms)
        return found

    return find


@F.pandas_udf(T.ArrayType(T.LongType()))
def _terms(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    find = term_finder(word_terms)
    for batch in texts:
        yield pd.Series([sorted(find(t)) for t in batch])


@dataclass
class FactorizationMachine:
    terms: np.ndarray  # kept hashes, ascending
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # terms x FACTORS

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities; a row holds positions in ``terms``."""
        at = np.concatenate([*rows, np.empty(0, dtype=np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return 1 / (1 + np.exp(-_margin(self, at, row, len(rows))[0]))


def _margin(m: FactorizationMachine, at: np.ndarray, row: np.ndarray, n: int):
    v = m.factors[at]
    sums = np.stack([np.bincount(row, v[:, k], n) for k in range(v.shape[1])], axis=1)
    single = np.bincount(row, m.linear[at] - 0.5 * (v**2).sum(axis=1), n)
    return np.clip(m.bias + single + 0.5 * (sums**2).sum(axis=1), -40, 40), v, sums


def fit(terms: np.ndarray, rows: list[np.ndarray], labels: np.ndarray) -> FactorizationMachine:
    """Adam on the whole, mean log loss with a small penalty on all weights."""
    n, size = len(rows), len(terms)
    share = (labels.sum() + 0.5) / (n + 1)
    rng = np.random.default_rng(0)
    m = FactorizationMachine(
        terms, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02, (size, FACTORS))
    )
    if not 0 < labels.sum() < n or not size:
        m.factors[:] = 0
        return m
    parts = []
    for i in range(0, n, AT_A_TIME):
        some = rows[i : i + AT_A_TIME]
        row = np.repeat(np.arange(len(some), dtype=np.int32), [len(r) for r in some])
        parts.append((np.concatenate(some), row, labels[i : i + AT_A_TIME]))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (np.zeros(1), m.linear, m.factors)]
    for epoch in range(1, EPOCHS + 1):
        slopes = [np.zeros(1), L2 * m.linear, L2 * m.factors]
        for at, row, wanted in parts:
            margin, v, sums = _margin(m, at, row, len(wanted))
            error = (1 / (1 + np.exp(-margin)) - wanted) / n
            each = error[row]
            pull = each[:, None] * (sums[row] - v)
            slopes[0] += error.sum()
            slopes[1] += np.bincount(at, each, size)
            slopes[2] += np.stack([np.bincount(at, pull[:, k], size) for k in range(FACTORS)], axis=1)
        steps = []
        for slope, (first, second) in zip(slopes, moments):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            change = first / (1 - 0.9**epoch) / (np.sqrt(second / (1 - 0.99**epoch)) + 1e-8)
            steps.append(0.1 * change)
        m.bias -= float(steps[0][0])
        m.linear -= steps[1]
        m.factors -= 0.2 * steps[2]
    return m


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """labels: doc_id, toxic. Learns from labelled rows outside the held-out fold."""
    chosen = training_labels(labels, "toxic", FOLDS, FOLD, rows)
    found = training_documents(docs, chosen).select("label", _terms("text").alias("terms"))
    found = materialize(found, "toxicity-terms")
    totals = {r.label: r.n for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = totals.get(1, 0) + 1, totals.get(0, 0) + 1

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, with_one, share = F.count("*"), F.sum("label"), F.count("*") / (ones + zeros)
    gain = 2 * (
        part(with_one, ones * share)
        + part(n - with_one, zeros * share)
        + part(ones - with_one, ones * (1 - share))
        + part(zeros - n + with_one, zeros * (1 - share))
    )
    counted = (
        found.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(gain.alias("gain"), n.alias("n"))
        .filter(F.col("n") > 1)
    )
    counted = materialize(counted, "toxicity-counts")
    telling = counted.filter(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "term").limit(TERMS)
    frequent = counted.orderBy(F.desc("n"), "term").limit(FREQUENT)
    kept = telling.select("term").collect() + frequent.select("term").collect()
    terms = np.array(sorted({r.term for r in kept}), dtype=np.int64)
    literal = F.array(*[F.lit(int(t)) for t in terms]).cast("array<bigint>")
    chosen = F.array_intersect("terms", literal).alias("terms")
    sample = found.select("label", chosen, F.xxhash64("terms").alias("hash")).toArrow()
    # Whole columns: Python objects for every term would take many times the memory.
    ends = np.cumsum([0, *sample["terms"].combine_chunks().value_lengths().to_numpy()])
    places = np.searchsorted(terms, sample["terms"].combine_chunks().flatten().to_numpy()).astype(np.int32)
    label = sample["label"].to_numpy()
    order = np.lexsort((label, sample["hash"].to_numpy()))
    rows_ = [np.sort(places[ends[i] : ends[i + 1]]) for i in order]
    return fit(terms, rows_, label[order].astype(float))


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TERMS rows, whatever the data

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        place = {int(t): i for i, t in enumerate(m.terms)}
        find = term_finder(lambda word: tuple(place[t] for t in word_terms(word) if t in place))
        for batch in texts:
            yield pd.Series(m.scores([np.array(sorted(find(t)), dtype=np.int64) for t in batch]))

    held = held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out")
    rows = docs.select("doc_id", held, scored("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    return score(docs, train(docs, labels, rows))
