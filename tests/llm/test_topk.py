import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockglass.llm import queries, topk


def test_query_equals_sql(same_as_sql):
    same_as_sql(queries.op3_top_k_search, queries.OP3_SQL)


def plain(rows, k=5, every=50):
    """Every query against every candidate, in whole numbers."""
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        asked = min(v for i, v in usable if i == q)
        scored = sorted((-sum(a * b for a, b in zip(asked, v)), i) for i, v in usable if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def _run(spark, rows, every=50, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumn("score", F.lit("x")).withColumn("shard", F.lit(1)).withColumn("v", F.lit(1))
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k).collect())


def _vectors(rng, n, dim=6):
    return [(i, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]


@pytest.mark.parametrize("shard,block,leaf", [(10_000, 10_000, 4), (40, 3, 8)])
def test_shards_blocks_and_leaves(spark, monkeypatch, shard, block, leaf):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "LEAF", leaf)
    rows = _vectors(np.random.default_rng(1), 300)
    rows += [(i, [0.5] * 6) for i in range(300, 360)]  # ties of one common vector
    assert _run(spark, rows) == plain(rows)


def test_tree_refuses_what_cannot_be_among_the_best():
    rng = np.random.default_rng(2)
    points = np.round(256 * np.repeat(rng.normal(size=(20, 8)), 200, axis=0) + rng.normal(size=(4000, 8)))
    tree = topk.BallTree(points, np.arange(4000))
    query = points[17]
    bounds = tree.bounds(query[None, :])[0]
    for node, (left, right) in enumerate(tree.children):
        if left < 0:
            start, end = tree.span[node]
            assert (tree.points[start:end] @ query).max() <= bounds[node]
    best = tree.search(query, -1, bounds, 5, -np.inf)
    wanted = sorted(((-s, i) for i, s in enumerate(points @ query)))[:5]
    assert best == [(-s, i) for s, i in wanted]
    assert tree.search(query, -1, bounds, 5, best[0][0] + 1) == []


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [2.0])]
    rows += [(6, [0.3, -0.3]), (6, [0.3, -0.3]), (None, [9.0, 9.0]), (50, [0.0, 0.0]), (50, [0.0, 0.0]), (7, [])]
    assert _run(spark, rows) == plain(rows)
    assert _run(spark, rows[:1]) == []
    assert _run(spark, []) == []


def test_one_vector_makes_up_most_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 50)
    rows = [(100, [1.0, 2.0])] * 400 + [(i, [1.0, 2.0]) for i in range(200)]
    assert _run(spark, rows) == [r for r in plain(rows)]


def test_large_components(spark):
    rows = [(0, [1e14, 1.0]), (1, [3e12, -2.0]), (2, [-1e13, 7.0]), (3, [0.25, 0.25]), (50, [1.0, 1e13])]
    got, wanted = _run(spark, rows), plain(rows)
    limit = 2**63 - 1
    assert got == [(q, r, i, max(-limit - 1, min(limit, s))) for q, r, i, s in wanted]


def test_search_of_no_candidates():
    empty = pd.DataFrame({"vec_id": [], "v": []})
    asked = pd.DataFrame({"query_id": [1], "v": [[1, 2]], "kth": [None]})
    assert topk.best_of_shard(asked, empty, 5).empty
