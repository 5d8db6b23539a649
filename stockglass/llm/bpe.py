"""Byte-level BPE encoding and decoding of whole texts, in linear time.

A pattern cuts the text into pieces, and the bytes of each piece are merged on
their own: the neighbours whose joint token has the lowest rank first, of equals
the leftmost. A sequence of tokens is what these merges give exactly if that holds
for every two neighbours alone, as a merge across a boundary depends on the tokens
at its two sides only. So no merge is carried out on a piece:

* From the first of its bytes, as Latin-1 characters, on the longest token is taken
  that may stand beside the one before it; next come the tokens that are beginnings of
  it. Where none may follow, the position is dead and the search goes back by one token.
* A trie of the tokens tells how far the bytes at a position go on as the beginning of
  a token, and a table of all beginnings the longest token in each. Only positions that
  the search comes to are looked up.

The tokens taken are always the one encoding of the bytes before, so a dead
position is dead for good and each is left at most once. Whether two tokens may be
neighbours follows from how merges build each of them, and is remembered, as are the
ids of pieces. A piece that is a token is that token, whatever merges would give.
The tables of a vocabulary, and what is remembered, serve all tasks of a Python worker.

Cases: null and empty texts have no ids and decode to no bytes. Texts and pieces
are encoded whole, of any length, in memory proportional to one text. Special
tokens are ordinary text. Unknown ids do not decode; null ids give null bytes.
Repeated rows are encoded one by one. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 200_000  # pieces an encoder remembers at a time, twice
PAIRS = 500_000  # pairs of tokens it remembers at a time
_NEVER = float("inf")


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    """Reads a rank file, on the driver."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge_steps(piece: str, ranks: dict[str, int]) -> Iterator[tuple[float, list[str]]]:
    """Each merge on a short piece: its rank and the parts it leaves."""
    parts = list(piece)
    while len(parts) > 1:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return
        rank, at = min(pairs)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        yield rank, parts


class Encoder:
    """ranks: the bytes of each token; all single bytes are tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import ahocorasick
        import regex

        self.find = regex.compile(pattern).findall
        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        if missing := [b for b in range(256) if chr(b) not in self.ranks]:
            raise ValueError(f"no token for byte {missing[0]}")
        self.texts = {rank: token for token, rank in self.ranks.items()}
        self.histories: dict[int, tuple[list[float], list[str], list[str]]] = {}
        built = {token: rank for token, rank in self.ranks.items() if self._history(rank) is not None}
        self.trie = ahocorasick.Automaton()
        self.reach: dict[str, int] = {}  # the longest token in each beginning of one
        for token, rank in built.items():
            self.trie.add_word(token, rank)
            longest = -1
            for n in range(1, len(token) + 1):
                longest = self.reach[token[:n]] = built.get(token[:n], longest)
        self.widest = max(map(len, built))
        self.lengths = {rank: len(token) for token, rank in built.items()}
        self.shorter = {rank: self.reach.get(token[:-1], -1) for token, rank in built.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # pieces remembered before the last REMEMBERED

    def _history(self, rank: int) -> tuple[list[float], list[str], list[str]] | None:
        """How merges build a token: the rank of each step, and the first and the last
        part before it; None if they never end in the token."""
        known = self.histories.get(rank)
        if known is None:
            token = self.texts[rank]
            steps, firsts, lasts = [], [token[0]], [token[-1]]
            for step, parts in merge_steps(token, self.ranks):
                steps.append(step)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            if firsts[-1] != token:
                return None
            known = self.histories[rank] = [*steps, _NEVER], firsts, lasts
        return known

    def _apart(self, before: int, token: int) -> bool:
        """Whether the merges of the two together end in the two."""
        (l_steps, _, lasts), (r_steps, firsts, _) = self._history(before), self._history(token)
        i = j = 0
        while True:
            # Each side goes on as alone until a merge across is the next of all.
            across = self.ranks.get(lasts[i] + firsts[j], _NEVER)
            if across < l_steps[i] and across <= r_steps[j]:
                return False
            if l_steps[i] == r_steps[j] == _NEVER:
                return True
            if l_steps[i] <= r_steps[j]:
                i += 1
            else:
                j += 1

    def merged(self, piece: str) -> list[int]:
        """The tokens of a piece given as Latin-1 characters."""
        lengths, shorter, reach, pairs = self.lengths, self.shorter, self.reach, self.pairs
        walk, widest = self.trie.longest_prefix, self.widest
        dead = bytearray(len(piece) + 1)
        found: list[int] = []
        at, before = 0, -1
        ahead = piece[:widest]
        token = reach[ahead[: walk(ahead)]]
        while True:
            while token >= 0:
                end = at + lengths[token]
                if not dead[end]:
                    if before < 0:
                        break
                    pair = before, token
                    apart = pairs.get(pair)
                    if apart is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        apart = pairs[pair] = self._apart(before, token)
                    if apart:
                        break
                token = shorter[token]
            if token < 0:
                dead[at] = 1
                token = found.pop()
                before = found[-1] if found else -1
                at -= lengths[token]
                token = shorter[token]
                continue
            found.append(token)
            if end == len(piece):
                return found
            at, before = end, token
            ahead = piece[at : at + widest]
            token = reach[ahead[: walk(ahead)]]

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece, four bytes each."""
        ids = self.older.get(piece)
        if ids is None:
            latin = piece if piece.isascii() else piece.encode("utf-8", "surrogatepass").decode("latin-1")
            whole = self.ranks.get(latin)
            ids = array("i", self.merged(latin) if whole is None else [whole]).tobytes()
        if len(self.pieces) >= REMEMBERED:
            self.older, self.pieces = self.pieces, {}
        if len(piece) <= 64:
            self.pieces[piece] = ids
        return ids

    def __call__(self, text: str | None) -> np.ndarray:
        new = self._piece
        # Looked up anew each time: ``_piece`` may put another table in its place.
        parts = [self.pieces.get(p) or new(p) for p in self.find(text or "")]
        return np.frombuffer(b"".join(parts), np.int32)


class Vocabulary:
    """Tokens as the driver reads them. What follows from them a Python worker makes
    once, and keeps as long as the broadcast."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self.ranks, self.pattern)

    @cached_property
    def tokens(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def decimals(self) -> dict[int, str]:
        return {rank: str(rank) for rank in self.tokens}


def _shared(df: DataFrame, path: str, pattern: str = PATTERN):
    return df.sparkSession.sparkContext.broadcast(Vocabulary(load_ranks(path), pattern))


def encoded(docs: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, ids."""
    shared = _shared(docs, path, pattern)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = shared.value.encoder
        for batch in texts:
            yield pd.Series([encoder(t) for t in batch], dtype=object)

    return docs.select("doc_id", encode("text").alias("ids"))


def decoded(rows: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, bytes; rows: doc_id, ids. Bytes need not be whole characters."""
    shared = _shared(rows, path)

    @F.pandas_udf(T.BinaryType())
    def decode(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        texts = shared.value.tokens
        for batch in lists:
            found = [None if ids is None else b"".join(map(texts.__getitem__, ids)) for ids in batch]
            yield pd.Series(found, dtype=object)

    return rows.select("doc_id", decode("ids").alias("bytes"))


def digests(docs: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids as decimal text and of the bytes they
    decode to. Both ways in one pass, so ids do not travel."""
    shared = _shared(docs, path, pattern)

    def both_ways(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, tokens, decimals = shared.value.encoder, shared.value.tokens, shared.value.decimals
        for batch in batches:
            rows = []
            for text in batch:
                ids = encoder(text).tolist()
                joined = " ".join(map(decimals.__getitem__, ids)).encode()
                back = b"".join(map(tokens.__getitem__, ids))
                digest = hashlib.sha256(joined).hexdigest(), hashlib.sha256(back).hexdigest()
                rows.append((len(ids), *digest))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    result = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    both: Column = F.pandas_udf(both_ways, result)("text")
    return docs.select("doc_id", both.alias("d")).select("doc_id", "d.*")
