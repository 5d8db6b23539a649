"""SentencePiece encoding and decoding of whole texts by a streaming Viterbi search.

The model is a byte-fallback BPE vocabulary. A sequence of pieces is what the model's
merges give for a text exactly if that holds for every two neighbours. So the
lattice of pieces has one surviving path to each position: the piece that ends
there, goes back to a position whose own piece may stand before it, and is unique.
The search walks the text once. As no piece is longer than the window, later
pieces start in the window only; once the paths from all its positions go back to
one boundary, the ids before it are committed and forgotten.

Where no piece can cross, before a run of blanks, around line breaks and between two
characters that are neighbours in no piece, paths meet at once. Texts are cut there.
Every id comes from the search; the ids of parts and stretches it has committed are
remembered, and a part that comes again takes them from there.

Blanks count as U+2581, one is put in front of a text, characters outside the
vocabulary become the ids of their bytes. Decoding joins the pieces and takes the
first blank away; bytes that are no UTF-8 become U+FFFD, and U+2581 itself comes
back as a blank, as the model has it.

Cases: null and empty texts have no ids and decode to an empty text. Texts are
encoded whole, of any length; repeated rows one by one. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
REMEMBERED = 400_000  # stretches a task remembers at a time
PARTS = 200_000  # parts of stretches, and pairs of pieces, it remembers
YIELDED = 200  # texts whose ids a task hands on at a time
STRETCH = 48  # characters of a stretch or part that is remembered, at most
_STRETCHES = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")


@dataclass
class Vocabulary:
    """scores: of each ordinary piece; ids: of those; byte_ids: 256; texts: bytes of each id."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    texts: list[bytes]
    longest: int = field(init=False)
    cuttable: bool = field(init=False)
    #: By character the next node of the pieces' tree, and the piece that ends there if any.
    tree: dict[str, list] = field(init=False)
    neighbours: set[str] = field(init=False)  # two characters side by side in a piece

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.tree = {}
        for piece in self.ids:
            children = self.tree
            for c in piece[:-1]:
                children = children.setdefault(c, [{}, None])[0]
            children.setdefault(piece[-1], [{}, None])[1] = piece
        self.neighbours = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        crossing = (p for p in self.ids if "\n" in p or BLANK in p.lstrip(BLANK))
        self.cuttable = next(crossing, None) is None


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Reads a model file, on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, ids, texts = {}, {}, []
    byte_ids = [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[1:-1], 16)
            byte_ids[value] = i
            texts.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i):
            texts.append(b"")
        else:
            scores[piece], ids[piece] = model.get_score(i), i
            texts.append(piece.encode())
    return Vocabulary(scores, ids, byte_ids, texts)


def merge_steps(text: str, scores: dict[str, float]) -> Iterator[tuple[float, list[str]]]:
    """The model's merges on a short text: the best pair first, of equals the leftmost.
    Each step has its score and the parts it leaves."""
    parts = list(text)
    while len(parts) > 1:
        pairs = [(-scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
        if not pairs:
            return
        cost, at = min(pairs)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        yield -cost, parts


def merged(text: str, scores: dict[str, float]) -> list[str]:
    parts = list(text)
    for _, parts in merge_steps(text, scores):
        pass
    return parts


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.stretches: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # stretches remembered before the last REMEMBERED
        self.parts: dict[str, bytes] = {}
        self.followers: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.histories: dict[str, tuple[list[float], list[str], list[str]] | None] = {}

    def _history(self, piece: str) -> tuple[list[float], list[str], list[str]] | None:
        """How merges build a piece: the score of each step, and the first and the last
        part before it; None if they do not end in the piece."""
        if piece in self.histories:
            return self.histories[piece]
        scores, firsts, lasts = [], [piece[0]], [piece[-1]]
        for score, parts in merge_steps(piece, self.v.scores):
            scores.append(score)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        whole = firsts[-1] == piece
        self.histories[piece] = (scores + [-np.inf], firsts, lasts) if whole else None
        return self.histories[piece]

    def _stay_apart(self, before: str, piece: str) -> bool:
        """Whether the model's merges of the two together end in the two. before: ''
        at the start and after a character outside the vocabulary, which never merges."""
        right = self._history(piece)
        if right is None or not before:
            return right is not None
        if BLANK * 2 in before + piece:  # pieces of blanks have equal scores: place decides
            return merged(before + piece, self.v.scores) == [before, piece]
        left = self._history(before)
        # Both sides are merged best first. A merge across comes if it beats either's next;
        # of equals the leftmost comes first.
        (l_scores, _, lasts), (r_scores, firsts, _) = left, right
        i = j = 0
        while True:
            across = self.v.scores.get(lasts[i] + firsts[j])
            if across is not None and across > l_scores[i] and across >= r_scores[j]:
                return False
            if l_scores[i] == r_scores[j] == -np.inf:
                return True
            if l_scores[i] >= r_scores[j]:
                i += 1
            else:
                j += 1

    def _followers(self, before: str) -> dict[str, bool]:
        """A new, empty table of what may stand behind a piece."""
        if self.pairs >= PARTS:
            self.followers.clear()
            self.pairs = 0
        return self.followers.setdefault(before, {})

    def _converged(self, starts: list[int], base: int, end: int) -> int:
        """The boundary all paths from the window before ``end`` go back to."""
        front = set(range(max(base, end - self.v.longest + 1), end + 1))
        while len(front) > 1:
            last = max(front)
            front.remove(last)
            front.add(starts[last - base])
        return front.pop()

    def _commit(self, pieces: list[str | None], starts: list[int], base: int, end: int, out: array) -> None:
        """Append the ids of the path from ``base`` to ``end``."""
        path = []
        while end > base:
            path.append(pieces[end - base])
            end = starts[end - base]
        ids = self.v.ids
        for piece in reversed(path):
            i = ids.get(piece)
            if i is None:
                out.extend([self.v.byte_ids[octet] for octet in piece.encode("utf-8", "surrogatepass")])
            else:
                out.append(i)

    def search(self, text: str) -> array:
        """The ids of a text in which blanks are U+2581 already."""
        tree, n, window = self.v.tree, len(text), self.v.longest
        out = array("i")
        # The piece that ends at each position from ``base`` on, and where it starts.
        base, pieces, starts = 0, [""] + [None] * min(n, 3 * window), [0] * (1 + min(n, 3 * window))
        check = 2 * window  # where convergence is tested next
        for start in range(n):
            before = pieces[start - base]
            if before is None:  # no piece ends here: a character outside the vocabulary
                before = pieces[start - base] = text[start - 1]
                starts[start - base] = start - 1
                if before not in tree:
                    before = ""
            known = self.followers.get(before)
            if known is None:
                known = self._followers(before)
            children, at = tree, start - base
            for c in text[start : start + window]:
                node = children.get(c)
                if node is None:
                    break
                at += 1
                children, piece = node
                if piece is not None and pieces[at] is None:
                    apart = known.get(piece)
                    if apart is None:
                        apart = known[piece] = self._stay_apart(before, piece)
                        self.pairs += 1
                    if apart:
                        pieces[at], starts[at] = piece, start
            if start == check:
                boundary = self._converged(starts, base, start)
                check = start + window
                if boundary > base:
                    self._commit(pieces, starts, base, boundary, out)
                    del pieces[: boundary - base], starts[: boundary - base]
                    base = boundary
                    check = base + 2 * window
                room = min(n, start + 3 * window) - base + 1 - len(pieces)
                pieces.extend([None] * room)
                starts.extend([0] * room)
        if n and pieces[n - base] is None:
            pieces[n - base], starts[n - base] = text[n - 1], n - 1
        self._commit(pieces, starts, base, n, out)
        return out

    def _part(self, text: str) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            ids = self.search(text).tobytes()
            if len(text) <= STRETCH:
                if len(self.parts) >= PARTS:
                    self.parts.clear()
                self.parts[text] = ids
        return ids

    def _stretch(self, text: str) -> bytes:
        """The ids of a stretch, as ``search`` gives them, four bytes each."""
        ids = self.older.get(text)
        if ids is None:
            neighbours, begin, found = self.v.neighbours, 0, []
            for i in range(1, len(text)):
                if text[i - 1 : i + 1] not in neighbours:
                    found.append(self._part(text[begin:i]))
                    begin = i
            found.append(self._part(text[begin:]))
            ids = b"".join(found)
        if len(text) <= STRETCH:
            if len(self.stretches) >= REMEMBERED:
                self.older, self.stretches = self.stretches, {}
            self.stretches[text] = ids
        return ids

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        text = BLANK + text.replace(" ", BLANK)
        if not self.v.cuttable:
            return np.frombuffer(self.search(text), np.int32)
        new = self._stretch
        # Looked up anew each time: ``_stretch`` may put another table in its place.
        parts = [self.stretches.get(s) or new(s) for s in _STRETCHES.findall(text)]
        return np.frombuffer(b"".join(parts), np.int32)


def decode(ids: np.ndarray, texts: list[bytes]) -> str:
    """texts: ``Vocabulary.texts``."""
    whole = b"".join(map(texts.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return whole.replace(BLANK, " ").removeprefix(" ")


def _shared(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(load_vocabulary(path))  # the model's pieces


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *values])))


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """The first column, and the second as a list, of a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, YIELDED):
            part = batch.slice(at, YIELDED)
            yield part.column(0), part.column(1).to_pylist()


def _with_id(docs: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([docs.schema["doc_id"], *fields])


IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def encoded(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids."""
    shared = _shared(docs, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for doc_ids, texts in _in_parts(batches):
            ids = _lists([encoder(t) for t in texts])
            yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, _with_id(docs, IDS))


def decoded(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, text; rows: doc_id, ids. Null ids give a null text."""
    shared = _shared(rows, path)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = shared.value.texts
        for doc_ids, lists in _in_parts(batches):
            found = [None if ids is None else decode(np.array(ids, np.int32), texts) for ids in lists]
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(found, pa.string())], ["doc_id", "text"])

    schema = _with_id(rows, T.StructField("text", T.StringType()))
    return rows.select("doc_id", "ids").mapInArrow(back, schema)


def round_trips(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids, decoded_sha256 of the text the ids decode to, and
    whether that is the text."""
    shared = _shared(docs, path)
    schema = _with_id(
        docs,
        T.StructField("n_ids", T.LongType()),
        IDS,
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("round_trip", T.BooleanType()),
    )

    def both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for doc_ids, texts in _in_parts(batches):
            lists = [encoder(t) for t in texts]
            backs = [decode(ids, shared.value.texts) for ids in lists]
            digests = [hashlib.sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in backs]
            columns = [
                doc_ids,
                pa.array([len(ids) for ids in lists], pa.int64()),
                _lists(lists),
                pa.array(digests, pa.string()),
                pa.array([b == (t or "") for b, t in zip(backs, texts)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc_id", "text").mapInArrow(both_ways, schema)
