import math
import string
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from stockglass.llm import quality, queries
from tests.llm.conftest import DATA


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    got = queries.op10_quality(spark, data)
    assert got.count() == 10_000
    rows = got.join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").filter("held_out").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(r.predicted for r in bad) <= 0.02 * len(bad)


def test_fold_range_and_decision(spark):
    for r in queries.op10_quality(spark, DATA).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_scores_are_log_density_differences(monkeypatch):
    rng = np.random.default_rng(1)
    size = len(quality.STATISTICS)
    rows = np.vstack([rng.normal(0, 1, (300, size)), rng.normal(0.5, 2, (200, size))])
    labels = np.repeat([0, 1], [300, 200])
    m = quality.fit(rows, labels)
    assert ((m.scores(rows) >= 0.5) == labels).mean() > 0.95
    z = (rows[:5] - m.centre) / m.scale
    density = []
    for k in (0, 1):
        covariance = np.linalg.inv(m.inverses[k].T @ m.inverses[k])
        d = z - m.means[k]
        distance = np.einsum("ij,jk,ik->i", d, np.linalg.inv(covariance), d)
        density.append(-0.5 * distance - 0.5 * np.linalg.slogdet(covariance)[1])
    odds = m.prior + density[1] - density[0]
    assert np.allclose(m.scores(rows[:5]), 1 / (1 + np.exp(-np.clip(odds, -40, 40))))


def plain_statistics(text):
    words = (text or "").split()
    if not words:
        return [0.0] * len(quality.STATISTICS)
    n, seen = len(words), Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    marks = [string.ascii_uppercase, string.digits, "!?", "|", "#$%&*+=<>@^_~{}[]\\/", ".", ",;:", "\n"]
    rate = lambda count: math.log1p(100 * count / (n + 20))
    return [
        math.log1p(n),
        math.log((sum(map(len, words)) + 100) / (n + 20)),
        *(rate(sum(c in m for c in text)) for m in marks),
        math.log((len(seen) + 20) / (n + 20)),
        rate(sum(a == b for a, b in zip(words, words[1:]))),
        rate(max(seen.values()) - 1),
        rate(sum(len(w) <= 3 for w in words)),
        rate(len(lines) - len(set(lines))),
        math.log1p(max(map(len, lines))),
    ]


def test_query_equals_plain_densities(spark):
    """The whole result, from plain statistics and inverted covariances."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    taught = [i for i in texts if labels.get(i) in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(taught) < quality.TRAIN_ROWS
    x = np.array([plain_statistics(texts[i]) for i in taught])
    y = np.array([labels[i] for i in taught])
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale <= 1e-9] = 1
    z, size = (x - centre) / scale, x.shape[1]
    own = [np.cov(z[y == k], rowvar=False, bias=True) for k in (0, 1)]
    both = sum((y == k).sum() * c for k, c in enumerate(own)) / len(y)
    means, covariances = [z[y == k].mean(axis=0) for k in (0, 1)], []
    for k, c in enumerate(own):
        lean = 0.3 + 0.7 * size / (size + (y == k).sum())
        c = (1 - lean) * c + lean * both
        covariances.append(0.98 * c + 0.02 * np.diag(np.diag(c)) + 1e-3 * np.eye(size))
    prior = np.log((y.sum() + 0.5) / ((y == 0).sum() + 0.5))

    def score(text):
        density = []
        for mean, covariance in zip(means, covariances):
            d = (np.array(plain_statistics(text)) - centre) / scale - mean
            density.append(-0.5 * d @ np.linalg.solve(covariance, d) - 0.5 * np.linalg.slogdet(covariance)[1])
        return 1 / (1 + np.exp(-np.clip(prior + density[1] - density[0], -40, 40)))

    got = queries.op10_quality(spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert np.allclose([r.score for r in got], [score(texts[r.doc_id]) for r in got], rtol=1e-6, atol=1e-9)


def test_a_constant_statistic_is_no_singularity():
    rows = np.zeros((20, len(quality.STATISTICS)))
    rows[10:, 0] = 1
    m = quality.fit(rows, np.repeat([0, 1], 10))
    assert (m.scores(rows)[10:] > 0.5).all() and (m.scores(rows)[:10] < 0.5).all()


def test_nulls_blanks_long_texts_repeated_rows_and_clashing_columns(spark, documents):
    docs = [(i, f"Some text {i}, as one writes it." if i % 2 else "$$$ " * (i + 9)) for i in range(60)]
    labels = spark.createDataFrame(
        [(i, i % 2, 1.0) for i in range(60)] + [(None, 1, 1.0), (4, None, 1.0)],
        "doc_id long, quality int, score double",
    )
    rest = [(None, "$$$ " * 20), (100, None), (101, " \n"), (102, "$$$ " * 300_000), (103, "a"), (103, "a")]
    table = documents(docs + rest).withColumn("score", F.lit("x")).withColumn("label", F.lit(1))
    got = quality.quality(table, labels).collect()
    assert len(got) == 66 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[100].score == by_id[101].score
    assert by_id[None].predicted == by_id[102].predicted == by_id[8].predicted == 0
    assert by_id[7].predicted == 1


def test_without_labels_or_documents(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    (row,) = quality.quality(documents([(1, "a")]), labels).collect()
    assert row.score == 0.5 and row.predicted == 1
    assert quality.quality(documents([]), labels).collect() == []
