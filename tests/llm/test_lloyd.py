import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockglass.llm import lloyd, queries
from tests.llm.conftest import DATA

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """{(vec_id, code, error, label_error, digest): rows}, every distance computed."""
    kept = [(i, [math.floor(4096 * x) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), k) for i, v, k in kept]
    first = {}
    for i, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(i, v)
    first = list(first.values())[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for v in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v, _ in kept:
            for p in range(parts):
                groups[p, nearest(v, p)[1]].append(cut(v, p))
        for (p, e), members in groups.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, k, [nearest(v, p) for p in range(parts)]) for i, v, k in kept]
    totals = Counter()
    for _, k, near in found:
        totals[k] += sum(d for d, _ in near)
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), totals[k], digest) for i, k, near in found)


def codes(df):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_query_equals_sql(same_as_sql):
    same_as_sql(queries.op12_vector_codes, queries.OP12_SQL)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert codes(queries.op12_vector_codes(spark, DATA)) == plain(rows)


@given(
    st.lists(st.tuples(st.integers(-40, 40), st.integers(-3, 3)), min_size=1, max_size=120),
    st.lists(st.tuples(st.integers(-40, 40), st.integers(-3, 3)), min_size=1, max_size=9),
    st.sampled_from([1, 10**15]),
)
@settings(deadline=None, max_examples=200)
def test_trees_equal_comparing_all(points, entries, times):
    tree = lloyd.forest([np.array(p, dtype=np.int64) * times for p in points], 2, 1)[0]
    entries = np.array(entries, dtype=object) * times
    found, errors = tree.codes(entries)
    sums, counts = tree.totals(entries)
    wanted = defaultdict(list)
    for i, p in enumerate(points):
        d, e = min((sum((int(a) * times - int(b)) ** 2 for a, b in zip(p, c)), e) for e, c in enumerate(entries))
        assert (errors[i], found[i]) == (d, e)
        wanted[e].append(p)
    for e in range(len(entries)):
        assert counts[e] == len(wanted[e])
        assert [int(x) for x in sums[e]] == [times * sum(p[j] for p in wanted[e]) for j in range(2)]


def test_the_tree_covers_and_separates():
    points = np.random.default_rng(1).integers(-1000, 1000, (500, 3))
    tree = lloyd.CoverTree.build(points)
    away = lambda a, b: np.sqrt(((tree.points[a] - tree.points[b]) ** 2).sum(-1))
    leaves = 0
    for n, (start, end) in enumerate(zip(tree.start, tree.end)):
        assert away(start, np.arange(start, end)).max() <= tree.radius[n] + 1e-9
        below = np.arange(tree.child[n], tree.child[n] + tree.children[n])
        if not len(below):
            leaves += end - start
            continue
        assert tree.start[below[0]] == start and tree.end[below[-1]] == end
        assert (tree.radius[below] <= tree.radius[n] / 2).all()
        for a in below:
            for b in below[below > a]:
                assert away(tree.start[a], tree.start[b]) > tree.radius[n] / 2
    assert leaves == 500 and sorted(tree.order) == list(range(500))


def test_whole_subtrees_are_assigned(monkeypatch):
    """Of well-parted groups few points are compared one by one."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-50_000, 50_000, (16, 8))
    points = centres[rng.integers(0, 16, 1000)] + rng.integers(-40, 40, (1000, 8))
    tree = lloyd.CoverTree.build(points)
    compared = []
    real = lloyd.distances
    monkeypatch.setattr(lloyd, "distances", lambda p, e: compared.append(len(p)) or real(p, e))
    _, counts = tree.totals(centres)
    assert counts.sum() == 1000 and sum(compared) < 200


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "SHARE", 2)
    monkeypatch.setattr(lloyd, "BLOCK", 7)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=9).tolist(), i % 3) for i in range(20)]
    rows += [(3, [0.5] * 9, None), (None, [0.25] * 9, 1), (None, [0.1], 2), (21, [], None)]
    rows += [(7, [0.3] * 9, 5)] * 40  # a frequent label, equal points
    rows += [(22, None, 1), (23, [None] * 9, 1), (24, [float("nan")] * 9, 1), (25, [float("inf")] * 9, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("x")).withColumn("of", F.lit(1)).withColumn("error", F.lit(2))
    assert codes(lloyd.vector_codes(df)) == plain(rows)
    few = [(None, [1.0, 2.0], None), (5, [-1.0, 1.0], None), (5, [-2.0, 1.0], 1)]
    assert codes(lloyd.vector_codes(spark.createDataFrame(few, SCHEMA), parts=2)) == plain(few, parts=2)
    assert lloyd.vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert lloyd.vector_codes(nothing).collect() == []


@pytest.mark.parametrize("size", [1e9, 1e12])
def test_large_components(spark, size):
    rng = np.random.default_rng(4)
    rows = [(i, (size * rng.normal(size=8)).tolist(), 1) for i in range(30)]
    got = codes(lloyd.vector_codes(spark.createDataFrame(rows, SCHEMA), rounds=2))
    top = 2**63 - 1
    wanted = Counter({(i, c, min(e, top), min(t, top), d): n for (i, c, e, t, d), n in plain(rows, rounds=2).items()})
    if size == 1e9:
        assert got == wanted
    else:  # the label's error is the sum of errors, each at its limit
        assert {k[:3] for k in got} == {k[:3] for k in wanted}
