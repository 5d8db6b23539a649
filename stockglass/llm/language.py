"""Language of a text: first its family, then the language within the family.

Features are shares of hashed 1- to 4-grams of the letters in lower case, with one
mark for whatever stands between two words. One linear support vector machine for
each family, against the rest, picks the family; one for each pair of its
languages then votes. Whole texts are counted, with array operations over pieces
of bounded length.

Learned from the text and the given language of a bounded number of documents of
every language, chosen by the hash of their id.

Cases: a text that is null or has no letter is ``und`` with score 0; so is every
text if there was nothing to learn from. Languages without a known family are
families of their own. Rows without a language teach nothing. Repeated rows are
predicted one by one. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockglass.llm.common import held_out, materialize
from stockglass.llm.labelled import training_documents

FOLDS, FOLD = 3, 1
ROWS_PER_LANGUAGE = 400  # documents of a language the model is fitted to, about
TRAIN_ROWS = 2000  # documents of all languages, at most
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
GRAMS = (1, 2, 3, 4)
PENALTY = 1e-3
STEPS = 150
PIECE = 1 << 18  # characters of a text counted at a time
UNKNOWN = "und"
LEAST_SCORE = 0.25  # of a document that is accepted; mixtures of two languages stay above

# ISO 639-1 codes by language family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "sd", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "ug", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
}


class GramCounter:
    """Counts the grams of a text by bucket; knows which characters are letters."""

    def __init__(self):
        self.letter = np.array([chr(c).isalpha() for c in range(0x110000)])

    def _codes(self, piece: str, after_letter: bool) -> np.ndarray:
        """The letters' codes, with a 0 after each word."""
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.letter[codes]
        ends_word = ~letter & np.concatenate([[after_letter], letter[:-1]])
        return np.where(letter, codes, 0)[letter | ends_word]

    def __call__(self, text: str | None) -> np.ndarray:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        lower = (text or "").lower()
        past = np.zeros(1, dtype=np.uint32)  # the last codes of the piece before
        for at in range(0, len(lower), PIECE):
            new = self._codes(lower[at : at + PIECE], past[-1] != 0)
            codes = np.concatenate([past, new])
            for n in GRAMS:
                first = max(0, len(past) - n + 1)  # grams that end in this piece
                size = len(codes) - first - n + 1
                if len(new) and size > 0:
                    value = np.full(size, n, dtype=np.uint32)
                    for k in range(n):
                        value = value * np.uint32(0x01000193) ^ codes[first + k : first + k + size]
                    value *= np.uint32(0x9E3779B1)
                    counts += np.bincount(value >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
            past = codes[-max(GRAMS) + 1 :]
        return counts


def shares(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur and their shares."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint16), (counts[at] / max(1, counts.sum())).astype(np.float32)


SHARES = T.StructType([T.StructField(c, T.BinaryType()) for c in ("at", "share")])


@F.pandas_udf(SHARES)
def _shares(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    count = GramCounter()
    for batch in texts:
        packed = ([part.tobytes() for part in shares(count(t))] for t in batch)
        yield pd.DataFrame(packed, columns=SHARES.names)


def linear_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights, and the bias as the last one, of a squared-hinge machine; y is -1 or 1.

    Accelerated gradient steps, each class with half of the weight.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    y = y.astype(x.dtype)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    v = np.random.default_rng(0).normal(size=x.shape[1]).astype(x.dtype)
    for _ in range(20):
        v = x.T @ (weight * (x @ v))
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (2.2 * size + PENALTY)
    w = past = np.zeros(x.shape[1], dtype=x.dtype)
    for k in range(STEPS):
        ahead = w + k / (k + 3) * (w - past)
        short = np.maximum(0, 1 - y * (x @ ahead))
        past, w = w, ahead - step * (PENALTY * ahead - 2 * x.T @ (weight * y * short))
    return w


@dataclass
class LanguageModel:
    families: list[list[str]]  # the languages of each family
    scale: np.ndarray = field(default_factory=lambda: np.ones(BUCKETS, dtype=np.float32))
    family_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS + 1), np.float32))
    pairs: list[tuple[str, str]] = field(default_factory=list)  # positive side, negative side
    pair_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS + 1), np.float32))

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        """Language and score; margins: of the families, then of the pairs."""
        n = len(self.families)
        odds = np.exp(3 * (margins[:n] - margins[:n].max()))
        family = int(margins[:n].argmax())
        share = float(odds[family] / odds.sum())
        members = self.families[family]
        if len(members) == 1:
            return members[0], share
        votes = dict.fromkeys(members, 0.0)
        for (a, b), margin in zip(self.pairs, margins[n:]):
            if a in votes:
                p = 1 / (1 + np.exp(-3 * np.clip(margin, -10, 10)))
                votes[a] += p
                votes[b] += 1 - p
        best = max(members, key=lambda m: votes[m])
        return best, share * float(votes[best] / (len(members) - 1))


def fit(rows: np.ndarray, langs: np.ndarray) -> LanguageModel:
    """rows: shares of all buckets, a row per text."""
    known = sorted(set(langs))
    of = {code: name for name, codes in FAMILIES.items() for code in codes}
    groups: dict[str, list[str]] = {}
    for lang in known:
        groups.setdefault(of.get(lang, f"only {lang}"), []).append(lang)
    families = list(groups.values())
    scale = (1 / np.sqrt(rows.mean(axis=0) + 1e-6)).astype(np.float32)
    x = rows * scale
    place = {lang: i for i, members in enumerate(families) for lang in members}
    own = np.array([place[lang] for lang in langs])
    model = LanguageModel(families, scale)
    if len(families) > 1:
        sides = [np.where(own == i, 1, -1).astype(np.float32) for i in range(len(families))]
        model.family_weights = np.stack([linear_svm(x, y) for y in sides])
    else:
        model.family_weights = np.zeros((1, BUCKETS + 1), np.float32)
    weights = []
    for members in families:
        for a, b in combinations(members, 2):
            either = (langs == a) | (langs == b)
            weights.append(linear_svm(x[either], np.where(langs[either] == a, 1, -1).astype(np.float32)))
            model.pairs.append((a, b))
    if weights:
        model.pair_weights = np.stack(weights)
    return model


def train(
    docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, rows: int = TRAIN_ROWS
) -> LanguageModel:
    """docs: doc_id, text, lang. Learns from rows outside the held-out fold."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.filter(~held_out(F.col("doc_id"), FOLDS, FOLD)).select("doc_id", "text", "lang")
    sizes = materialize(usable.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    wanted = F.lit(min(rows_per_language, max(1, rows // max(1, sizes.count()))))
    # Each language draws about as many ids, by a hash that depends on nothing else.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30) * F.col("n")
    sizes = sizes.withColumnRenamed("lang", "size_lang")
    drawn = usable.select("doc_id", "lang").join(sizes, F.col("lang") == F.col("size_lang"))
    drawn = drawn.filter(place < 1.2 * wanted).groupBy("doc_id").agg(F.min(place).alias("place"))
    chosen = drawn.orderBy("place", "doc_id").limit(rows).select("doc_id")
    texts = training_documents(usable, chosen, "lang")
    sample = texts.select("lang", _shares("text").alias("x")).select("lang", "x.*").collect()
    sample = sorted((r for r in sample if r.at), key=lambda r: (r.lang, r.at, r.share))
    if not sample:
        return LanguageModel([])
    table = np.zeros((len(sample), BUCKETS), dtype=np.float32)
    for i, r in enumerate(sample):
        table[i, np.frombuffer(r.at, np.uint16)] = np.frombuffer(r.share, np.float32)
    return fit(table, np.array([r.lang for r in sample]))


class Predictor:
    def __init__(self, model: LanguageModel):
        self.model, self.count = model, GramCounter()
        both = np.vstack([model.family_weights, model.pair_weights]).astype(np.float64)
        self.weights, self.bias = both[:, :-1] * model.scale, both[:, -1]

    def __call__(self, text: str | None) -> tuple[str, float]:
        counts = self.count(text)
        total = counts.sum()
        if not total or not self.model.families:
            return UNKNOWN, 0.0
        return self.model.decide(self.weights @ (counts / total) + self.bias)


PREDICTION = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def with_prediction(docs: DataFrame, model: LanguageModel, name: str) -> DataFrame:
    """docs and a column ``name`` of lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few weights per bucket

    @F.pandas_udf(PREDICTION)
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = Predictor(shared.value)
        for batch in texts:
            yield pd.DataFrame([predict(t) for t in batch], columns=["lang_pred", "score"])

    return docs.withColumn(name, predicted("text"))


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row per document."""
    model = model or train(docs)
    held = held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out")
    rows = with_prediction(docs.select("doc_id", "text"), model, "p")
    return rows.select("doc_id", held, "p.lang_pred", "p.score")


def accepted(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents in a language that was recognised, columns unchanged."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    rows = with_prediction(whole, train(docs), "p")
    return rows.filter((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= least_score)).select("row.*")
