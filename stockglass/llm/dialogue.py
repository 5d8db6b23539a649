"""Repair of conversations by generalised LR parsing with weighted edits.

The roles of a conversation should form a talk:

    talk -> (nothing) | system pairs | pairs      pairs -> pairs pair | pair
    pair -> user assistant

Rows come in order of their turns. For each, every live stack may keep the row, give
it another role or delete it, and may first insert empty rows; each way is a shift
of the LR automaton with its price. Stacks are lists that share what lies below,
and stacks with equal tops are merged: the cheapest stays, of equal costs the one
whose edits, as letters, come first. What may follow depends on the top alone in
this grammar, so the merged stack is never missed. All live stacks, with their
costs relative to the cheapest, are one of few configurations, and the step from one
to the next is remembered.

Rows are shuffled once, by conversation, and pass a task in order. A task keeps for
each live stack the digest of the repaired text so far, and for each row where its
stacks came from, so memory does not grow with texts, and by some bytes a row. A
conversation is one sequence, and so is its digest: one task reads it, as a stream.

The first letter of a role counts. Of the faults of a row the first counts: blank,
duplicate (role and text were seen before), truncated (does not end in . ! or ?).

Cases: null roles and texts are one space. Rows without a turn come first, rows with
one turn by role and text. A null id is an id. An empty role is no role of the
grammar. A conversation without rows is repaired already. Repeated rows are
duplicates. Very long texts are hashed whole. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}  # those a row may be given
SPACES = " \t\n\x0b\x0c\r"
#: A stack dearer than the cheapest by more never wins. What may follow it may follow the
#: cheapest too, after two insertions at most, and but for a system row, which can go.
SPREAD = 2 * INSERT + DELETE
DAMAGE = 20  # one in so many rows suffers each kind of damage
_LONG = 2**63 - 1
_RETURNED = 2_000  # conversations or edits a task hands on at a time

# The LR automaton of the grammar above.
# 0: at the start; 1: after system; 2: after user; 3: user assistant; 4: a first pair;
# 5: pairs; 6: system pairs; 7: pairs and a pair.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (5, "u"): 2, (6, "u"): 2, (2, "a"): 3}
REDUCE = {3: ("pair", 2), 4: ("pairs", 1), 7: ("pairs", 2)}
GOTO = {
    (0, "pair"): 4,
    (1, "pair"): 4,
    (5, "pair"): 7,
    (6, "pair"): 7,
    (0, "pairs"): 5,
    (1, "pairs"): 6,
}
ACCEPT = {0, 5, 6}

#: A state and the stack below it.
Stack = tuple[int, Any]
#: Live stacks and their costs above the cheapest, in the order of their edits.
Frontier = tuple[tuple[Stack, int], ...]
#: What a row brings to a stack: the place of the stack it came from in the frontier
#: before, the letters of the edits, and the roles of rows inserted and of the row;
#: the row's is "" where it keeps its own, None where it goes.
Move = tuple[int, str, tuple[str, ...], str | None]

START: Frontier = (((0, None), 0),)


def shift(stack: Stack, initial: str) -> Stack | None:
    """The stack after a row, reduced as far as it goes; None if it may not follow."""
    state = SHIFT.get((stack[0], initial))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        symbol, length = REDUCE[stack[0]]
        for _ in range(length):
            stack = stack[1]
        stack = (GOTO[stack[0], symbol], stack)
    return stack


def _insertions(stack: Stack) -> Iterator[tuple[Stack, tuple[str, ...]]]:
    """The stack, and those that inserted rows lead to; none visits a top twice."""
    waiting: list[tuple[Stack, tuple[str, ...], frozenset[int]]] = [(stack, (), frozenset([stack[0]]))]
    for stack, roles, seen in waiting:
        yield stack, roles
        for initial, role in ROLES.items():
            after = shift(stack, initial)
            if after is not None and after[0] not in seen:
                waiting.append((after, (*roles, role), seen | {after[0]}))


@lru_cache(maxsize=1 << 16)
def step(frontier: Frontier, initial: str, fault: str) -> tuple[Frontier, int, tuple[Move, ...]]:
    """The frontier after a row, the cost of its cheapest stack above that before, and
    the move to each stack.

    Edits of a frontier all end with that of the row, so none begins another, and their
    order is that of the frontier before, then of the letters added.
    """
    best: dict[int, tuple[int, int, str, Stack, Move]] = {}

    def offer(stack: Stack | None, cost: int, at: int, letter: str, inserted: tuple[str, ...], role: str | None):
        if stack is not None:
            letters = "I" * len(inserted) + letter
            way = cost + INSERT * len(inserted), at, letters, stack, (at, letters, inserted, role)
            if stack[0] not in best or way[:3] < best[stack[0]][:3]:
                best[stack[0]] = way

    for at, (top, cost) in enumerate(frontier):
        for stack, inserted in _insertions(top):
            offer(stack, cost + DELETE, at, "D", inserted, None)
            if fault in ("blank", "duplicate"):
                continue
            price = cost + (TRUNCATED if fault == "truncated" else 0)
            offer(shift(stack, initial), price, at, "K", inserted, "")
            for other, role in ROLES.items():
                offer(shift(stack, other), price + REROLE, at, "R", inserted, role)
    least = min(way[0] for way in best.values())
    ways = sorted((way for way in best.values() if way[0] <= least + SPREAD), key=lambda way: way[1:3])
    return tuple((way[3], way[0] - least) for way in ways), least, tuple(way[4] for way in ways)


@lru_cache(maxsize=1 << 12)
def finish(frontier: Frontier) -> tuple[int, int, tuple[str, ...]]:
    """Cost, place in the frontier and roles inserted of the cheapest whole talk."""
    ends = (
        (cost + INSERT * len(roles), at, "I" * len(roles), roles)
        for at, (top, cost) in enumerate(frontier)
        for stack, roles in _insertions(top)
        if stack[0] in ACCEPT
    )
    cost, at, _, roles = min(ends)
    return cost, at, roles


class Repair:
    """One conversation, row by row. The digests take part only with ``hashed``."""

    def __init__(self, hashed: bool = True):
        self.frontier, self.cost = START, 0
        self.history: list[tuple[Move, ...]] = []
        self.digests = [(hashlib.sha256(), False)] if hashed else None
        self.initial: str | None = None
        self.first = self.last = None
        self.turns = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        self.frontier, more, moves = step(self.frontier, initial if initial in ("s", "u", "a") else "", fault)
        self.cost += more
        self.history.append(moves)
        if self.digests is not None:
            self.digests = [self._after(move, role, text) for move in moves]

    def _after(self, move: Move, role: str, text: str):
        at, _, inserted, given = move
        digest, begun = self.digests[at]
        lines = [f"{r}:" for r in inserted]
        if given is not None:
            lines.append(f"{given or role}:{text}")
        if not lines:
            return digest, begun
        digest = digest.copy()
        digest.update((("\n" if begun else "") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
        return digest, True

    def _path(self) -> tuple[list[Move], tuple[str, ...]]:
        """The moves of the cheapest talk in order, and the roles inserted after them."""
        _, at, roles = finish(self.frontier)
        path = []
        for moves in reversed(self.history):
            path.append(moves[at])
            at = moves[at][0]
        return path[::-1], roles

    def edits(self) -> Iterator[tuple[int, list[str], str | None]]:
        """(place of the row, roles inserted before it, its role); the last has no row."""
        path, roles = self._path()
        for place, (_, _, inserted, role) in enumerate(path):
            yield place, list(inserted), role
        yield len(path), list(roles), None

    def report(self) -> dict[str, int | str]:
        cost, at, roles = finish(self.frontier)
        path, _ = self._path()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        digest, begun = self.digests[at]
        if roles:
            digest = digest.copy()
            digest.update((("\n" if begun else "") + "\n".join(f"{r}:" for r in roles)).encode())
        return {
            "gaps": min(gaps, _LONG),
            **self.counts,
            "cost": self.cost + cost,
            "audit": "".join(letters for _, letters, _, _ in path) + "I" * len(roles),
            "repaired_sha256": digest.hexdigest(),
        }


REPORT = [
    *(T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    T.StructField("audit", T.StringType()),
    T.StructField("repaired_sha256", T.StringType()),
]
EDITS = [
    T.StructField("place", T.LongType()),
    T.StructField("inserted", T.ArrayType(T.StringType())),
    T.StructField("given", T.StringType()),
]


def clean(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: all rows as they are; none is gone."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(False).alias("gone"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """As ``clean``, each row damaged as the hash of its id and turn says: dropped,
    emptied, left without sentence ends, repeated, or given to the user."""

    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % DAMAGE
    rows = clean(conversations).withColumn("kind", kind)
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone, fault: each conversation in one partition, in
    order. One shuffle; the rows that are looked through for a first are there already."""
    again = F.row_number().over(W.partitionBy("conv_id", "role", "text", "gone").orderBy("turn")) > 1
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = F.when(end == "", "blank").when(F.col("again"), "duplicate")
    fault = fault.when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    return (
        rows.repartition("conv_id")
        .withColumn("again", again)
        .withColumn("fault", fault)
        .select("conv_id", "turn", "role", "text", "gone", "fault")
        .sortWithinPartitions("conv_id", *_order())
    )


def _conversations(
    batches: Iterator[pa.RecordBatch], hashed: bool
) -> Iterator[tuple[pa.Array, Repair]]:
    """The id, as an array of one, and the repair of each conversation of a partition."""
    current, key, repair = None, None, None
    for batch in batches:
        ids = batch.column(0)
        columns = (batch.column(i).to_pylist() for i in range(6))
        for row, (conv_id, turn, role, text, gone, fault) in enumerate(zip(*columns)):
            if repair is None or conv_id != key:
                if repair is not None:
                    yield current, repair
                current, key, repair = ids.slice(row, 1), conv_id, Repair(hashed)
            if not gone:
                repair.add(turn, role, text, fault)
    if repair is not None:
        yield current, repair


def reports(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256
    of every conversation. rows: of ``clean`` or ``damaged``."""
    schema = T.StructType([rows.schema["conv_id"], *REPORT])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        found: list[dict] = []

        def table() -> pa.RecordBatch:
            kinds = [pa.string() if f.dataType == T.StringType() else pa.int64() for f in REPORT]
            columns = [pa.array([r[f.name] for r in found], kind) for f, kind in zip(REPORT, kinds)]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *columns], schema.names)

        for conv_id, repair in _conversations(batches, True):
            ids.append(conv_id)
            found.append(repair.report())
            if len(found) >= _RETURNED:
                yield table()
                ids.clear()
                found.clear()
        if found:
            yield table()

    return _ordered(rows).mapInArrow(report, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the conversations after the cheapest edits, place
    counted from 0. rows: of ``clean`` or ``damaged``."""
    schema = T.StructType([rows.schema["conv_id"], *EDITS])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv_id, repair in _conversations(batches, False):
            edits = list(repair.edits())
            for at in range(0, len(edits), _RETURNED):
                place, inserted, given = zip(*edits[at : at + _RETURNED])
                columns = [
                    pa.concat_arrays([conv_id] * len(place)),
                    pa.array(place, pa.int64()),
                    pa.array(inserted, pa.list_(pa.string())),
                    pa.array(given, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    edits = _ordered(rows).mapInArrow(edit, schema)
    edits = edits.withColumnRenamed("conv_id", "of").withColumnRenamed("place", "row")
    order = W.partitionBy("conv_id").orderBy(*_order())
    placed = rows.filter("NOT gone").withColumn("at", (F.row_number().over(order) - 1).cast("long"))
    here = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("at") == F.col("row"))
    line = F.struct(F.col("role"), F.col("text"))
    own = F.when(F.col("given") == "", F.array(line)).when(
        F.col("given").isNotNull(), F.array(F.struct(F.col("given").alias("role"), F.col("text")))
    )
    new = F.transform("inserted", lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    lines = F.concat(new, F.coalesce(own, F.array().cast("array<struct<role:string,text:string>>")))
    found = edits.join(placed, here, "left").select("of", "row", F.posexplode(lines).alias("part", "line"))
    number = F.row_number().over(W.partitionBy("of").orderBy("row", "part")) - 1
    return found.select(F.col("of").alias("conv_id"), number.cast("long").alias("place"), "line.*")


def damage_reports(conversations: DataFrame) -> DataFrame:
    return reports(damaged(conversations))
