"""Secrets in texts: fixed forms, and values beside a credential word that are hard to guess.

Three forms are found by pattern: assignments to a credential word, access key
ids, long hexadecimal strings. Beside them, the value in any wider credential
context is cut into the segments that are cheapest to guess: common words, with
capitals and letter-like signs, dates, repeats, walks on the keyboard or through
the alphabet, and single characters by brute force. A value is reported as
``guess`` if even that takes ``LEAST_COST`` decimal digits of guesses. Common words are
those of the corpus itself, counted over all documents, ranked by frequency.

Words, dates and the block of a repeat have ``LONGEST`` characters at most; repeats
and walks are of any length. One longer than that ends within so many characters of where
it can't go on, and no segment begins deep inside a long repeat, as going on with it is
cheaper. Positions that cost enough already are not gone on from, so a long value takes
time in proportion to its length, and a hard one is decided after some characters.

Positions are code points, ends exclusive. Cases: a null text is empty and has no
spans; texts and values are read whole, of any length; repeated rows are read one by
one. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockglass.llm.common import materialize

KINDS = ("assign", "access", "hex", "guess")
LEAST_COST = 10.0
RANKED_WORDS = 10_000
STEPS = 16  # sizes of counts that words are sorted into, for each doubling
ORDERED_PARTS = 8  # parts whose most frequent words reach the driver
COUNTED_WORDS = 300_000  # words a task counts before it hands its counts on
LONGEST = 24
SEGMENT_COST = math.log10(2)  # for each segment: where it ends, and of which sort it is

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs of 24 or more, each found whole
_CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|bearer|authorization
        |(?:api|access|private|auth|client|signing)[_-]?(?:key|token|secret))
        ["']?\s{0,4}(?:=>|->|[:=]|\bis\b)\s{0,4}["'`]?([^\s"'`<>]{6,})""",
    re.I | re.A | re.X,
)
_CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "credential", "bearer", "authorization", "key")
_TRAILING = ".,;:!?)]}"

_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_KEYS = {key: (x + 0.5 * y, y) for y, row in enumerate(_ROWS) for x, key in enumerate(row)}
_LEET = str.maketrans("013457@$!8", "oieastasib")
_CLASS_SIZES = (("0123456789", 10), ("abcdefghijklmnopqrstuvwxyz", 26), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26))
_CHARACTER = {c: math.log10(size) for members, size in _CLASS_SIZES for c in members}
_SIGN = math.log10(33)
_BEYOND = math.log10(500)  # outside ASCII
_YEAR = math.log10(200)
_DATE = math.log10(366 * 200)
_DATES = re.compile(
    r"(?P<y>(?:19|20)\d\d)"
    r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)?\d\d)"
    r"|(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])[-/.]?(?:(?:19|20)?\d\d)"
    r"|(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])",
    re.A,
)


def character_cost(c: str) -> float:
    return _CHARACTER.get(c, _SIGN if c < "\x80" else _BEYOND)


def word_cost(piece: str, ranks: dict[str, int]) -> float:
    """Cost of a common word, written with capitals or look-alikes; inf if it is none."""
    lower = piece.lower()
    rank, swaps = ranks.get(lower), 0
    if rank is None:
        plain = lower.translate(_LEET)
        rank, swaps = ranks.get(plain), sum(a != b for a, b in zip(plain, lower))
        if rank is None:
            return math.inf
    capitals = sum(c.isupper() for c in piece)
    if capitals in (0, len(piece)) or (capitals == 1 and piece[0].isupper()):
        shape = 0.3 * (capitals > 0)
    else:
        shape = math.log10(math.comb(len(piece), capitals))
    return math.log10(rank + 1) + shape + 0.3 * swaps


def date_cost(piece: str) -> float:
    m = _DATES.fullmatch(piece)
    return math.inf if m is None else _YEAR if m["y"] else _DATE


def block_cost(block: str, ranks: dict[str, int]) -> float:
    """Cost of what a repeat repeats: characters, or if it is longer its segments."""
    return sum(map(character_cost, block)) if len(block) <= 4 else guess_cost(block, ranks)


def repeat_cost(piece: str, ranks: dict[str, int]) -> float:
    """Cost of a block, repeated."""
    costs = [math.inf]
    for size in range(1, min(LONGEST, len(piece) // 2) + 1):
        times, rest = divmod(len(piece), size)
        if not rest and len(piece) >= 3 and piece == piece[:size] * times:
            costs.append(block_cost(piece[:size], ranks) + math.log10(times))
    return min(costs)


def _alphabet_cost(length: int, step: int) -> float:
    return math.log10(26 * length) + 0.3 * (step < 0)


def _keyboard_cost(length: int, turns: int, capitals: bool) -> float:
    return math.log10(47 * length) + turns * math.log10(4.6) + 0.3 * capitals


def _move(a: str, b: str) -> tuple[float, int] | None:
    """The way from a key to its neighbour; None if they are no neighbours."""
    (ax, ay), (bx, by) = _KEYS.get(a.lower(), (9e9, 0)), _KEYS.get(b.lower(), (-9e9, 0))
    dx, dy = bx - ax, by - ay
    return (dx, dy) if abs(dx) <= 1 and abs(dy) <= 1 and (dx, dy) != (0, 0) else None


def walk_cost(piece: str) -> float:
    """Cost of three or more neighbouring keys, or of steps through an alphabet."""
    if len(piece) < 3:
        return math.inf
    steps = {ord(b) - ord(a) for a, b in zip(piece, piece[1:])}
    if steps in ({1}, {-1}):
        return _alphabet_cost(len(piece), steps.pop())
    moves = [_move(a, b) for a, b in zip(piece, piece[1:])]
    if None in moves:
        return math.inf
    turns = 1 + sum(a != b for a, b in zip(moves, moves[1:]))
    return _keyboard_cost(len(piece), turns, any(c.isupper() for c in piece))


def segment_cost(piece: str, ranks: dict[str, int]) -> float:
    """The cheapest way to guess ``piece`` as one segment."""
    if len(piece) == 1:
        return character_cost(piece)
    cheapest = min(repeat_cost(piece, ranks), walk_cost(piece))
    if len(piece) <= LONGEST:
        cheapest = min(cheapest, word_cost(piece, ranks), date_cost(piece))
    return SEGMENT_COST + cheapest


def _alike(value: str, i: int, j: int) -> int:
    """How many characters from ``i`` and from ``j`` on are the same; i < j."""
    low, size = 0, 64
    while value[i + low : i + low + size] == value[j + low : j + low + size] and j + low < len(value):
        low += min(size, len(value) - j - low)
        size *= 2
    while size:
        if j + low + size <= len(value) and value[i + low : i + low + size] == value[j + low : j + low + size]:
            low += size
        size //= 2
    return low


class _Walks:
    """The walks of a value. Each is followed once, from where it is first asked for."""

    def __init__(self, value: str):
        self.value = value
        self.begin = self.end = 0  # of the keys followed last
        self.turns: list[int] = []  # changes of way up to each move
        self.capitals: list[int] = []  # capitals before each key

    def _follow(self, start: int) -> None:
        self.begin, self.turns, self.capitals = start, [], [0]
        at, way = start, None
        while at + 1 < len(self.value):
            move = _move(self.value[at], self.value[at + 1])
            if move is None:
                break
            self.turns.append((self.turns[-1] if self.turns else 0) + (way is not None and move != way))
            self.capitals.append(self.capitals[-1] + self.value[at].isupper())
            at, way = at + 1, move
        self.end = at + 1
        self.capitals.append(self.capitals[-1] + self.value[at].isupper())

    def from_(self, start: int) -> Iterator[tuple[int, float]]:
        """(end, cost) of walks from ``start`` on."""
        value = self.value
        if start + 1 < len(value) and abs(step := ord(value[start + 1]) - ord(value[start])) == 1:
            end = start + 2
            while end < len(value) and ord(value[end]) - ord(value[end - 1]) == step:
                end += 1
            for stop in _ends(start + 3, end, start):
                yield stop, _alphabet_cost(stop - start, step)
        if not self.begin <= start < self.end:
            self._follow(start)
        first, begin = start - self.begin, self.begin
        for stop in _ends(start + 3, self.end, start):
            turns = 1 + self.turns[stop - 2 - begin] - self.turns[first]
            capitals = self.capitals[stop - begin] > self.capitals[first]
            yield stop, _keyboard_cost(stop - start, turns, capitals)


def _ends(first: int, last: int, start: int, size: int = 1) -> Iterator[int]:
    """The ends, ``size`` apart from ``first`` to ``last``, that are near ``start`` or ``last``."""
    near = min(last, start + LONGEST)
    yield from range(first, near + 1, size)
    if last > near:
        far = max(near + 1, last - LONGEST)
        yield from range(far + (first - far) % size, last + 1, size)


def guess_cost(value: str, ranks: dict[str, int], enough: float = math.inf) -> float:
    """Decimal digits of the guesses the cheapest segmentation of ``value`` takes. Any
    cost of ``enough`` may come back as infinite."""
    n = len(value)
    costs = [0.0] + [math.inf] * n
    walks = _Walks(value)
    reach = inside = 0  # the last end that is cheap enough; the end of a long repeat's inner part
    for start in range(n):
        if start > reach:
            break
        base = costs[start]
        if base >= enough or start < inside:
            continue
        found = [(start + 1, character_cost(value[start]))]
        for end in range(start + 2, min(n, start + LONGEST) + 1):
            piece = value[start:end]
            found.append((end, SEGMENT_COST + word_cost(piece, ranks)))
            if piece[0].isdigit():
                found.append((end, SEGMENT_COST + date_cost(piece)))
        for size in range(1, min(LONGEST, (n - start) // 2) + 1):
            if value[start : start + size] == value[start + size : start + 2 * size]:
                last = start + size + _alike(value, start, start + size)
                cost = SEGMENT_COST + block_cost(value[start : start + size], ranks)
                for end in _ends(start + 2 * size, last, start, size):
                    if end - start >= 3:
                        found.append((end, cost + math.log10((end - start) // size)))
                if start >= LONGEST and last - start > 4 * LONGEST:
                    inside = max(inside, last - 3 * LONGEST)
        found += [(end, SEGMENT_COST + cost) for end, cost in walks.from_(start)]
        for end, cost in found:
            if base + cost < costs[end]:
                costs[end] = base + cost
                if base + cost < enough:
                    reach = max(reach, end)
    return costs[n]


def base_spans(text: str, lower: str) -> list[tuple[int, int, str]]:
    """start, end, kind of the fixed forms. lower: the text in lower case."""
    spans = []
    if any(w in lower for w in _ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return spans


def context_values(text: str, lower: str) -> list[tuple[int, int]]:
    """start, end of the values beside a credential word."""
    if not any(w in lower for w in _CONTEXT_WORDS):
        return []
    values = []
    for m in _CONTEXT.finditer(text):
        value = m[1].rstrip(_TRAILING)
        if len(value) >= 6:
            values.append((m.start(1), m.start(1) + len(value)))
    return values


def find_secrets(text: str | None, ranks: dict[str, int]) -> tuple[list[tuple[int, int, str]], int]:
    """All spans by start, then kind; how many credential values are easy to guess."""
    text = text or ""
    lower = text.lower()
    spans = base_spans(text, lower)
    taken = sorted(spans)
    easy = 0
    for start, end in context_values(text, lower):
        hard = guess_cost(text[start:end], ranks, LEAST_COST) >= LEAST_COST
        easy += not hard
        if hard and not any(s < end and start < e for s, e, _ in taken):
            spans.append((start, end, "guess"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])), easy


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


WORD_COUNTS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
FOUND = T.StructType(
    [
        *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
        T.StructField("n_easy", T.LongType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[str] = Counter()

    def handed_on() -> pd.DataFrame:
        words = {w: n for w, n in counts.items() if 3 <= len(w) <= LONGEST and w.isalpha()}
        counts.clear()
        n = pd.Series(list(words.values()), dtype="int64")
        return pd.DataFrame({"word": pd.Series(list(words), dtype=object), "n": n})

    for batch in batches:
        for text in batch["text"]:
            counts.update((text or "").lower().split())
            if len(counts) >= COUNTED_WORDS:
                yield handed_on()
    yield handed_on()


def common_words(docs: DataFrame, words: int = RANKED_WORDS) -> dict[str, int]:
    """The most frequent words of all documents and their ranks, from 1; ties by word."""
    counts = docs.select("text").mapInPandas(_count_words, WORD_COUNTS)
    totals = materialize(counts.groupBy("word").agg(F.sum("n").alias("n")), "secrets-words")
    # Only words as frequent as the last one wanted may be are put in order.
    size = F.floor(F.log2("n") * STEPS).cast("int")
    seen, least = 0, 0
    for least, words_of_size in sorted(totals.groupBy(size.alias("size")).count().collect(), reverse=True):
        seen += words_of_size
        if seen >= words:
            break
    few = totals.filter(size >= F.lit(least)).repartition(ORDERED_PARTS)
    top = few.orderBy(F.desc("n"), "word").limit(words).collect()
    return {r.word: i for i, r in enumerate(top, 1)}


def secrets(docs: DataFrame, ranks: dict[str, int] | None = None) -> DataFrame:
    """doc_id, the number of spans of each kind, n_easy, base_sha256, spans."""
    ranks = common_words(docs) if ranks is None else ranks
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # RANKED_WORDS at most

    @F.pandas_udf(FOUND)
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                spans, easy = find_secrets(text, shared.value)
                counts = Counter(kind for _, _, kind in spans)
                base = joined([s for s in spans if s[2] != "guess"])
                digest = hashlib.sha256(base.encode()).hexdigest()
                rows.append((*(counts[k] for k in KINDS), easy, digest, joined(spans)))
            yield pd.DataFrame(rows, columns=FOUND.names)

    return docs.select("doc_id", found("text").alias("f")).select("doc_id", "f.*")
