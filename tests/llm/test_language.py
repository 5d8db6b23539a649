import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockglass.llm import language, queries
from tests.llm.conftest import DATA


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op9_language_id(spark, "/root/testdata/sf0.01")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_families_and_pairs(model):
    assert model.families == [["de", "en"], ["es", "fr"]]
    assert model.pairs == [("de", "en"), ("es", "fr")]


def plain_counts(text):
    """Grams one by one: a mark before the text and after each word."""
    codes = [0]
    for c in text.lower():
        if c.isalpha():
            codes.append(ord(c))
        elif codes[-1]:
            codes.append(0)
    counts = np.zeros(language.BUCKETS, dtype=np.int64)
    for n in language.GRAMS:
        for i in range(len(codes) - n + 1):
            if n == 1 and i == 0:  # the mark in front is no gram of its own
                continue
            value = n
            for c in codes[i : i + n]:
                value = value * 0x01000193 % 2**32 ^ c
            counts[value * 0x9E3779B1 % 2**32 >> (32 - language.BUCKET_BITS)] += 1
    return counts


@pytest.mark.parametrize("piece", [1, 2, 7, 10_000])
@pytest.mark.parametrize("text", ["", "-- 1", "a", "Der Fluß, l'été!", "x" * 20, "ab  12cd\n𝒳é" * 9])
def test_counts_in_pieces(monkeypatch, piece, text):
    monkeypatch.setattr(language, "PIECE", piece)
    assert (language.GramCounter()(text) == plain_counts(text)).all()


def plain_vote(text, model):
    """Family, then the votes of its pairs, one machine at a time; the score too."""
    counts = plain_counts(text or "")
    if not counts.sum():
        return language.UNKNOWN, 0.0
    x = counts / counts.sum() * model.scale.astype(float)
    margin = lambda w: float(x @ w[:-1].astype(float) + w[-1])
    odds = [np.exp(3 * margin(w)) for w in model.family_weights]
    family = int(np.argmax(odds))
    members, share = model.families[family], odds[family] / sum(odds)
    if len(members) == 1:
        return members[0], share
    votes = Counter()
    for (a, b), w in zip(model.pairs, model.pair_weights):
        if a in members:
            for_a = 1 / (1 + np.exp(-3 * max(-10, min(10, margin(w)))))
            votes[a] += for_a
            votes[b] += 1 - for_a
    best = max(members, key=votes.get)
    return best, share * votes[best] / (len(members) - 1)


def test_query_equals_plain_votes(spark):
    """The whole result, from grams counted one by one."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    learned = language.train(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op9_language_id(spark, DATA).collect()}
    wanted = {i: plain_vote(text, learned) for i, text in texts.items()}
    assert {i: p for i, (p, _) in got.items()} == {i: p for i, (p, _) in wanted.items()}
    assert np.allclose([got[i][1] for i in texts], [wanted[i][1] for i in texts], rtol=1e-6, atol=1e-9)


def test_held_out_languages_teach_nothing(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    rows = lambda d: sorted(language.identify(d).collect())
    assert rows(docs) == rows(other)


def test_machine_separates_and_ignores_the_number_of_rows():
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(1, 1, (900, 5)), rng.normal(-1, 1, (60, 5))])
    y = np.repeat([1.0, -1.0], [900, 60])
    w = language.linear_svm(x, y)
    right = np.sign(x @ w[:-1] + w[-1]) == y
    assert right[:900].mean() > 0.93 and right[900:].mean() > 0.93


def test_more_than_two_languages_in_a_family():
    rng = np.random.default_rng(4)
    langs = np.repeat(["de", "en", "nl", "eo"], 40)
    rows = np.zeros((160, language.BUCKETS), dtype=np.float32)
    for i, lang in enumerate(langs):
        rows[i, 50 * ["de", "en", "nl", "eo"].index(lang) + rng.integers(0, 30, 20)] = 0.05
    m = language.fit(rows, langs)
    assert m.families == [["de", "en", "nl"], ["eo"]] and len(m.pairs) == 3
    both = np.vstack([m.family_weights, m.pair_weights])
    got = [m.decide((x * m.scale) @ both[:, :-1].T + both[:, -1])[0] for x in rows]
    assert (np.array(got) == langs).mean() > 0.95


def test_nulls_blanks_long_texts_repeated_rows_and_clashing_columns(spark, documents, model):
    (english,) = spark.read.parquet(f"{DATA}/documents.parquet").filter("lang = 'en'").select("text").take(1)
    rows = [(None, english.text), (1, None), (2, " 12 -- 3"), (3, english.text * 2000), (4, "§§"), (4, "§§")]
    docs = documents(rows).withColumn("score", F.lit("x")).withColumn("p", F.lit(1)).withColumn("row", F.lit(1))
    got = language.identify(docs, model).collect()
    assert sorted((str(r.doc_id), r.lang_pred, r.score > 0.5) for r in got) == [
        ("1", "und", False),
        ("2", "und", False),
        ("3", "en", True),
        ("4", "und", False),
        ("4", "und", False),
        ("None", "en", True),
    ]


def test_accepted_documents_keep_their_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("row", F.lit(1))
    extra = docs.limit(2).withColumn("text", F.lit("--- 17")).withColumn("doc_id", F.lit(-1).cast("long"))
    kept = language.accepted(docs.unionAll(extra))
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() and kept.filter("doc_id < 0").isEmpty()


def test_nothing_to_learn_from_and_no_rows(documents):
    (row,) = language.identify(documents([(1, "some text")])).collect()
    assert row.lang_pred == "und" and row.score == 0
    assert language.identify(documents([])).collect() == []
    assert language.accepted(documents([])).collect() == []
