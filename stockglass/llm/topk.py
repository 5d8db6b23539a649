"""Exact top-k inner products by a ball tree per shard.

Vectors are quantised to whole numbers, so scores are exact. Candidates are dealt
into shards, queries into blocks, both of bounded size. A shard builds a ball tree
and answers the queries of a block one by one: nodes are visited in the order of
the largest inner product their ball allows, and the search ends where that falls
below the k-th score so far. Each query first searches one shard; the k-th score
found there goes with it to all others, which mostly need only to refuse.

Cases: vectors that are null or hold null or non-finite components take no part,
nor do rows without an id. A shorter vector counts as filled up with zeros. Rows
with the query's own id are no candidates for it. Repeated candidates count as
often as they occur, up to k; a repeated query is asked once, of several vectors
under one id the least. Ties go to the smaller id. Fewer than k candidates are
all returned. Scores beyond a long end at its limits. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockglass.llm.common import materialize

K = 5
SCALE = 256
QUERY_EVERY = 50
SHARD = 16_384  # candidates of a shard, about
BLOCK = 4096  # queries of a block, about
LEAF = 128
_EXACT = 2.0**53
_LONG = np.iinfo(np.int64)


class BallTree:
    """Points in nested balls; ``ids`` and ``points`` in the order of the leaves."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        centres, radii, self.children, self.span = [], [], [], []
        order = np.argsort(ids, kind="stable")
        pieces: list[np.ndarray] = []
        filled = 0
        waiting = [(order, -1, 0)]
        while waiting:
            at, parent, side = waiting.pop()
            node, inside = len(centres), points[at]
            centre = inside.mean(axis=0)
            away = np.sqrt(((inside - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(away.max())
            self.children.append([-1, -1])
            self.span.append((0, 0))
            if parent >= 0:
                self.children[parent][side] = node
            if len(at) <= LEAF or radii[-1] == 0:
                self.span[node] = (filled, filled + len(at))
                filled += len(at)
                pieces.append(np.sort(at))
                continue
            one = inside[away.argmax()]
            other = inside[((inside - one) ** 2).sum(axis=1).argmax()]
            half = np.argsort(inside @ (other - one), kind="stable")
            middle = len(at) // 2
            waiting += [(at[half[:middle]], node, 0), (at[half[middle:]], node, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        by_leaf = np.concatenate(pieces)
        for start, end in self.span:
            leaf = by_leaf[start:end]
            by_leaf[start:end] = leaf[np.argsort(ids[leaf], kind="stable")]
        self.points, self.ids = points[by_leaf], ids[by_leaf]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest score each ball allows for each query, rounding on the safe side."""
        size = np.sqrt((queries**2).sum(axis=1))[:, None]
        reach = size * (self.radii + np.sqrt((self.centres**2).sum(axis=1)))
        return queries @ self.centres.T + size * self.radii + 1e-9 * reach + 1e-6

    def search(
        self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, kth: float
    ) -> list[tuple[float, int]]:
        """The best scores of at least ``kth`` as (score, id), best first."""
        best: list[tuple[float, int]] = []  # a heap; its first is the worst: (score, -id)
        nodes = [(-bounds[0], 0)]
        while nodes:
            bound, node = heapq.heappop(nodes)
            if -bound < kth:
                break
            left, right = self.children[node]
            if left >= 0:
                for child in (left, right):
                    allowed = min(-bound, bounds[child])  # a ball's points are its parent's too
                    if allowed >= kth:
                        heapq.heappush(nodes, (-allowed, child))
                continue
            start, end = self.span[node]
            scores = self.points[start:end] @ query
            ids = self.ids[start:end]
            usable = np.flatnonzero((scores >= kth) & (ids != own))
            # A leaf is in order of ids, so a stable sort puts smaller ids first.
            top = usable[np.argsort(-scores[usable], kind="stable")[:k]]
            for s, i in zip(scores[top].tolist(), ids[top].tolist()):
                (heapq.heappush if len(best) < k else heapq.heappushpop)(best, (s, -i))
            if len(best) == k:
                kth = max(kth, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _exhaustive(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> list[tuple]:
    """Whole-number arithmetic for components too large for the tree's."""
    rows = []
    for q, v in zip(queries["query_id"], queries["v"]):
        scores = (
            (sum(int(a) * int(b) for a, b in zip(v, c)), -int(i))
            for i, c in zip(candidates["vec_id"], candidates["v"])
            if i != q
        )
        for s, i in heapq.nlargest(k, scores):
            rows.append((q, -i, min(max(s, _LONG.min), _LONG.max)))
    return rows


def best_of_shard(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """query_id, vec_id, score; queries: query_id, v, kth; candidates: vec_id, v."""
    rows: list[tuple] = []
    if len(queries) and len(candidates):
        width = max(max(map(len, queries["v"])), max(map(len, candidates["v"])), 1)
        asked, points = _matrix(queries["v"], width), _matrix(candidates["v"], width)
        if np.abs(asked).max() * np.abs(points).max() * width >= _EXACT:
            rows = _exhaustive(queries, candidates, k)
        else:
            tree = BallTree(points, candidates["vec_id"].to_numpy())
            for i in range(0, len(asked), 256):
                bounds = tree.bounds(asked[i : i + 256])
                for j, bound in enumerate(bounds, i):
                    q, kth = queries["query_id"].iat[j], queries["kth"].iat[j]
                    found = tree.search(asked[j], q, bound, k, -np.inf if pd.isna(kth) else kth)
                    rows += [(q, vec_id, int(score)) for score, vec_id in found]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")


RESULT = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and v, whole numbers, of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    whole = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c).cast("long"))
    usable = F.col("vec_id").isNotNull() & F.forall(x, finite)
    return embeddings.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(embeddings: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score. is_query: a condition on vec_id."""
    rows = quantised(embeddings).groupBy("vec_id", "v").agg(F.count("*").alias("rows"))
    copies = F.array_repeat(F.col("vec_id"), F.least(F.col("rows"), F.lit(k)).cast("int"))
    points = materialize(rows.select(F.explode(copies).alias("vec_id"), "v"), "topk-points")
    asked = points.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = materialize(asked, "topk-queries")
    shards = -(-points.count() // SHARD) or 1
    blocks = -(-asked.count() // BLOCK) or 1
    candidates = points.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)))
    candidates = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("home", F.pmod(F.xxhash64("query_id", "v"), F.lit(shards)))

    def search(key, queries: pd.DataFrame, inside: pd.DataFrame) -> pd.DataFrame:
        return best_of_shard(queries, inside, k)

    def meet(queries: DataFrame) -> DataFrame:
        right = candidates.groupBy("shard", "block")
        return queries.groupBy("shard", "block").cogroup(right).applyInPandas(search, RESULT)

    first = meet(asked.withColumn("shard", F.col("home")).withColumn("kth", F.lit(None).cast("double")))
    if shards > 1:
        first = materialize(first, "topk-first")
        enough = F.when(F.count("*") == k, F.min("score").cast("double")).alias("kth")
        known = asked.join(first.groupBy("query_id").agg(enough), "query_id", "left")
        every = F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")
        rest = known.withColumn("shard", F.explode(every))
        first = first.unionAll(meet(rest.filter("shard <> home")))
    return _best(first, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
