import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockglass.llm import minhash, queries
from tests.llm.conftest import DATA


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_exact_likeness(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    got = queries.op7_document_fingerprints(spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    errors = []
    for r in got:
        text, other = texts[r.doc_id], texts[following[r.doc_id]]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r.fingerprint) == len(r.edited_fingerprint) == minhash.BINS
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, other)]
    errors = np.array(errors)
    assert abs(errors.mean()) < 0.02 and np.sqrt((errors**2).mean()) < 0.05


def plain_bins(hashes):
    """All bins' values by walking each empty bin's own sequence."""
    own = {}
    for h in hashes:
        at = (h >> 56) + 128
        own[at] = min(h, own.get(at, h))
    out = []
    for i in range(minhash.BINS):
        t = 0
        at = i
        while at not in own:
            at = (minhash.STARTS[i] + minhash.STEPS[i] * t) % minhash.BINS
            t += 1
        out.append(own[at])
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 60, 250, 400, 5000])
def test_densified_bins(spark, n):
    rng = np.random.default_rng(n)
    hashes = sorted(int(x) for x in rng.integers(-(2**63), 2**63 - 1, n))
    df = spark.createDataFrame([(hashes,)], "h array<long>")
    filled = minhash.let(F.col("h"), minhash._filled)
    (row,) = df.select(minhash.let(filled, minhash._densified).alias("bins")).collect()
    assert row.bins == plain_bins(hashes)


def _near(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    low = minhash.low_bits(F.col("a")), minhash.low_bits(F.col("b"))
    return df.select(minhash.likeness(*low)).first()[0]


def test_likeness(spark):
    words = [f"w{i}" for i in range(3000)]
    text = " ".join(words)
    assert _near(spark, text, text.upper()) == 1.0
    for n in (2900, 2000, 1000, 10):
        other = " ".join(words[:n] + [f"v{i}" for i in range(3000 - n)])
        assert abs(_near(spark, text, other) - jaccard(text, other)) < 0.1
    assert _near(spark, "only four words here", "four other words there") < 0.2
    assert _near(spark, "", "some words") < 0.2
    assert _near(spark, "", " \n") == 1.0


def test_cases(documents):
    long = "ab cd ef " * 100_000
    docs = documents([(None, "z"), (2, None), (2, "b c"), (2, "b c"), (1, "a"), (7, long)])
    docs = docs.withColumn("range", F.lit("x")).withColumn("low", F.lit(1)).withColumn("guest", F.lit(1))
    got = minhash.edited_fingerprints(docs).collect()
    assert sorted(r.n_chars for r in got) == [0, 1, 1, 3, 3, len(long)]
    (first,) = [r for r in got if r.doc_id == 7]
    nexts = {hashlib.sha256((long[: len(long) // 2] + t).encode()).hexdigest() for t in ("", "b c")}
    assert first.edited_sha256 in nexts
    assert {r.near_next for r in got if r.doc_id == 2} >= {1.0}  # the repeated rows meet
    last = [r for r in got if r.doc_id is None]
    assert last[0].edited_sha256 == hashlib.sha256(b"z").hexdigest()


def test_one_row_and_none(documents):
    (row,) = minhash.edited_fingerprints(documents([(1, "abcd")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert minhash.edited_fingerprints(documents([])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = queries.op7_document_fingerprints(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
