"""Product codes of vectors: Lloyd's rounds over cover trees of parts of the table.

Vectors become whole numbers, so every distance and sum is exact. They are cut into
equal consecutive parts, and each part position has a codebook of its own. Every
task cuts the rows it reads into blocks of bounded size and builds a cover tree for
each part position of a block: the root covers all points, the children of a node
lie at least half its radius apart and cover its points within that distance, and
the first of them is the node's own point. Sums over the points in the order of
the tree's leaves give the sum of any subtree as a difference of two.

The trees are written once. A round sends the codebooks to them. At a node of radius
r whose point is nearest to an entry at distance d, entries further than d + 2 r are
nearest to none of its points. If one entry is left, the whole subtree is assigned
by its sum; else its children are asked with the entries left, and the points of a
leaf are compared exactly. A task sends one sum for each entry, whatever it read.

Cases: vectors that are null or hold null or non-finite components take no part.
Shorter vectors, and lengths that parts do not divide, are filled up with zeros.
Components beyond a long end at its limits, as do errors. Ties go to the lower
entry. Codebooks start with fewer entries if there are fewer ids; of several vectors
under one id the least starts it, and a null id comes last. Repeated rows count as
often as they occur, equal points as one subtree. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockglass.llm.common import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16  # of a codebook, at most 256
ROUNDS = 6
BLOCK = 1024  # vectors whose trees are built together, at most
LEAF = 8  # points of a node that has no children, at most
SHARE = 256  # a label with more than one in so many rows is frequent
_SMALL = 2**26  # components below can be squared and added in 64 bits
_LONG = np.iinfo(np.int64)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact: points x entries."""
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float))


@dataclass
class CoverTree:
    """Nodes level by level. The points of a node are ``order[start:end]``, its own
    point is the first; its children are the nodes from ``child`` on."""

    points: np.ndarray  # in the order of the leaves
    order: np.ndarray  # their rows in the block
    sums: np.ndarray  # sums[i]: of the points before i
    start: np.ndarray
    end: np.ndarray
    radius: np.ndarray  # no point of the node is further from its own
    child: np.ndarray
    children: np.ndarray  # how many

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        order = np.arange(len(points))
        start, end, radius, child, children = [0], [len(points)], [], [], []
        at = 0
        while at < len(start):
            inside = order[start[at] : end[at]]
            away = _roots(distances(points[inside], points[inside[:1]])[:, 0])
            radius.append(away.max())
            child.append(len(start))
            groups = []
            if len(inside) > LEAF and radius[at] > 0:
                while len(inside):
                    near = away <= radius[at] / 2
                    groups.append(inside[near])
                    inside = inside[~near]
                    if len(inside):
                        away = _roots(distances(points[inside], points[inside[:1]])[:, 0])
                order[start[at] : end[at]] = np.concatenate(groups)
            ends = start[at] + np.cumsum([len(g) for g in groups], dtype=np.int64)
            start += [start[at], *ends[:-1].tolist()] if groups else []
            end += ends.tolist()
            children.append(len(groups))
            at += 1
        sums = np.concatenate([0 * points[:1], np.cumsum(points[order], axis=0)])
        arrays = (np.array(x) for x in (start, end, radius, child, children))
        return cls(points[order], order, sums, *arrays)

    def nearest(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, entry): spans of points that an entry is nearest to."""
        nodes = np.zeros(1, dtype=np.int64)
        left = np.ones((1, len(entries)), dtype=bool)
        while len(nodes):
            away = _roots(distances(self.points[self.start[nodes]], entries))
            away[~left] = np.inf
            best = away.min(axis=1, keepdims=True)
            reach = 2 * self.radius[nodes][:, None]
            left &= away <= (best + reach) * (1 + 1e-9) + 1e-6
            whole = left.sum(axis=1) == 1
            yield self.start[nodes[whole]], self.end[nodes[whole]], left[whole].argmax(axis=1)
            nodes, left = nodes[~whole], left[~whole]
            # Equal points go where the first does; those of other leaves are compared one by one.
            equal = self.radius[nodes] == 0
            spread = (self.children[nodes] == 0) & ~equal
            alone = _ranges(self.start[nodes[spread]], self.end[nodes[spread]] - self.start[nodes[spread]])
            first = np.concatenate([self.start[nodes[equal]], alone])
            last = np.concatenate([self.end[nodes[equal]], alone + 1])
            yield first, last, distances(self.points[first], entries).argmin(axis=1)
            inner = self.children[nodes] > 0
            count = self.children[nodes[inner]]
            left = np.repeat(left[inner], count, axis=0)
            nodes = _ranges(self.child[nodes[inner]], count)

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the points each entry is nearest to."""
        sums = np.zeros(entries.shape, dtype=self.points.dtype)
        counts = np.zeros(len(entries), dtype=np.int64)
        for first, last, entry in self.nearest(entries):
            np.add.at(sums, entry, self.sums[last] - self.sums[first])
            np.add.at(counts, entry, last - first)
        return sums, counts

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row of the block, and its squared distance."""
        code = np.empty(len(self.order), dtype=np.int64)
        for first, last, entry in self.nearest(entries):
            code[_ranges(first, last - first)] = np.repeat(entry, last - first)
        error = ((self.points - entries[code]) ** 2).sum(axis=1)
        back = np.argsort(self.order)
        return code[back], error[back]


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    before = np.cumsum(length) - length
    return np.repeat(first - before, length) + np.arange(int(length.sum()), dtype=np.int64)


def forest(vectors: list[np.ndarray], width: int, parts: int) -> list[CoverTree]:
    """A tree for each part of the vectors; ``width``: components of a part."""
    points = np.zeros((len(vectors), width * parts), dtype=np.int64)
    for i, v in enumerate(vectors):
        points[i, : len(v)] = v
    if len(points) and width and max(abs(int(points.min())), int(points.max())) >= _SMALL:
        points = points.astype(object)  # whole numbers of any size
    return [CoverTree.build(points[:, p * width : (p + 1) * width]) for p in range(parts)]


def _trees(blob: bytes) -> list[CoverTree]:
    return [CoverTree(**fields) for fields in pickle.loads(blob)]


def _entries(codebooks: list[list[list[int]]], tree: CoverTree, part: int) -> np.ndarray:
    entries = np.array(codebooks[part], dtype=object).reshape(len(codebooks[part]), tree.points.shape[1])
    large = entries.size and max(abs(entries.min()), abs(entries.max())) >= _SMALL
    return entries if large else entries.astype(tree.points.dtype)


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: whole numbers, of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
    return embeddings.filter(F.forall(x, finite)).select("vec_id", "label", whole.alias("v"))


def _first_vectors(rows: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids. A pass finds at least one further id."""
    known = rows.filter("vec_id IS NOT NULL").select("vec_id", "v")
    found: dict = {}
    while len(found) < entries:
        later = known.filter(F.col("vec_id") > F.lit(max(found))) if found else known
        least = later.orderBy("vec_id", "v").limit(entries).collect()
        if not least:
            without = rows.filter("vec_id IS NULL").agg(F.min("v").alias("v")).first()
            return [*found.values(), *([] if without.v is None else [without.v])]
        for r in least:
            found.setdefault(r.vec_id, r.v)
    return list(found.values())[:entries]


def _built(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """vec_id, label (of each vector of a block), trees."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                block = batch.iloc[at : at + BLOCK]
                trees = pickle.dumps([vars(t) for t in forest(block["v"].tolist(), width, parts)])
                ids = [None if pd.isna(i) else i for i in block["vec_id"]]
                labels = [None if pd.isna(i) else i for i in block["label"]]
                yield pd.DataFrame({"vec_id": [ids], "label": [labels], "trees": [trees]})

    # As text, ids and labels of any type stay what they are beside nulls.
    texts = rows.select(F.col("vec_id").cast("string"), F.col("label").cast("string"), "v")
    schema = "vec_id array<string>, label array<string>, trees binary"
    return materialize(texts.mapInPandas(build, schema), "lloyd-trees")


def _round(trees: DataFrame, codebooks: list[list[list[int]]]) -> list[list[list[int]]]:
    """The codebooks after one round."""

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros((len(c), len(c[0])), dtype=object) for c in codebooks]
        counts = [np.zeros(len(c), dtype=np.int64) for c in codebooks]
        for batch in batches:
            for blob in batch["trees"]:
                for part, tree in enumerate(_trees(blob)):
                    s, n = tree.totals(_entries(codebooks, tree, part))
                    sums[part] += s.astype(object)
                    counts[part] += n
        rows = [
            (part, entry, str(place_sum), int(counts[part][entry]), place)
            for part in range(len(codebooks))
            for entry in np.flatnonzero(counts[part]).tolist()
            for place, place_sum in enumerate(sums[part][entry])
        ]
        yield pd.DataFrame(rows, columns=["part", "entry", "total", "n", "place"])

    sent = trees.select("trees").mapInPandas(
        totals, "part int, entry int, total string, n long, place int"
    )
    # As many rows as the codebooks have components.
    found = sent.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    after = [[list(entry) for entry in book] for book in codebooks]
    for r in found.collect():
        after[r.part][r.entry][r.place] = int(r.total) // r.n
    return after


def learn(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[list[list[list[int]]], DataFrame]:
    """The codebooks (part, entry, component), and the trees they were learned from."""
    rows = quantised(embeddings, scale)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    trees = _built(rows, width, parts)
    firsts = [v + [0] * (width * parts - len(v)) for v in _first_vectors(rows, entries)]
    codebooks = [[v[p * width : (p + 1) * width] for v in firsts] for p in range(parts)]
    if firsts and width:
        for _ in range(rounds):
            codebooks = _round(trees, codebooks)
    return codebooks, trees


def coded(trees: DataFrame, codebooks: list[list[list[int]]]) -> DataFrame:
    """vec_id, label (both as text), code (the entry of each part), error."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, labels, blob in zip(batch["vec_id"], batch["label"], batch["trees"]):
                found = [t.codes(_entries(codebooks, t, p)) for p, t in enumerate(_trees(blob))]
                errors = sum(error.astype(object) for _, error in found)
                errors = [min(int(e), _LONG.max) for e in errors]
                codes = np.stack([c for c, _ in found], axis=1).tolist()
                yield pd.DataFrame({"vec_id": ids, "label": labels, "code": codes, "error": errors})

    return trees.mapInPandas(code, "vec_id string, label string, code array<int>, error long")


def _with_label_errors(rows: DataFrame) -> DataFrame:
    """rows with label_error, the error of all rows with their label.

    Frequent labels, fewer than SHARE, are looked up where the rows are; only the
    others are joined by label, and none of those is a large group.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG.max)).cast("long")
    totals = rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"), F.count("*").alias("n"))
    totals = materialize(totals, "lloyd-labels")
    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = F.col("n") * SHARE > size
    same = F.col("label").eqNullSafe(F.col("of"))
    often = F.broadcast(totals.filter(frequent).select("of", "label_error"))
    seldom = totals.filter(~frequent).select("of", "label_error")
    return (
        rows.join(often, same)
        .unionAll(rows.join(often, same, "left_anti").join(seldom, same))
        .drop("of")
    )


def vector_codes(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256."""
    codebooks, trees = learn(embeddings, parts, entries, rounds, scale)
    numbers = ",".join(str(x) for book in codebooks for entry in book for x in entry)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    rows = _with_label_errors(materialize(coded(trees, codebooks), "lloyd-codes"))
    digits = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return rows.select(
        F.col("vec_id").cast(embeddings.schema["vec_id"].dataType).alias("vec_id"),
        F.concat_ws("", digits).alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
