import hashlib
import os
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockglass.llm import bpe, queries
from tests.llm.conftest import DATA
from tests.llm.counting import CountedRanks

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def library(ranks):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


RANKS = {name: bpe.load_ranks(public_tokenizers.path(name)) for name in FILES}
MODELS = {name: library(ranks) for name, ranks in RANKS.items()}
ENCODERS = {name: bpe.Encoder(ranks) for name, ranks in RANKS.items()}


def plain(piece, ranks):
    """Merges on a list, one by one."""
    parts = [bytes([b]) for b in piece]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_the_pattern_and_file_are_the_public_ones():
    assert bpe.PATTERN == public_tokenizers.PATTERN
    assert RANKS[FILES[0]] == bpe.load_ranks()


def test_query_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.op13_byte_bpe(spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = MODELS[FILES[0]].encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


@pytest.mark.parametrize("name", FILES)
@given(text=st.text() | st.text("abcdehinorst éüß梦\n\t'0123.-=") | st.text("aeint "))
@settings(deadline=None, max_examples=300)
def test_any_text(name, text):
    assert list(ENCODERS[name](text)) == MODELS[name].encode_ordinary(text)


@given(st.data())
@settings(deadline=None, max_examples=150)
def test_any_ranks(data):
    """Vocabularies no merges were counted for, with tokens that merges never build."""
    more = data.draw(st.lists(st.text("abc", min_size=2, max_size=6), unique=True, max_size=25))
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(more)}
    encoder = bpe.Encoder(ranks)
    piece = data.draw(st.text("abc", min_size=1, max_size=40))
    if piece.encode() not in ranks:
        assert encoder.merged(piece) == plain(piece.encode(), ranks)
    assert list(encoder(piece)) == library(ranks).encode_ordinary(piece)


def test_long_pieces_take_linear_work(monkeypatch):
    """Every position is left at most once, so tokens tried are in proportion to bytes."""
    encoder = bpe.Encoder(RANKS[FILES[0]])
    rng = random.Random(5)
    for piece in ("a" * 30_000, "".join(rng.choices("thereingao", k=30_000)), "=" * 30_001, "ab" * 9_999):
        tried = []

        class Counted(dict):
            def __getitem__(self, token):
                tried.append(token)
                return dict.__getitem__(self, token)

        encoder.shorter = Counted(encoder.shorter)
        assert list(encoder(piece)) == MODELS[FILES[0]].encode_ordinary(piece)
        assert len(tried) < 12 * len(piece)


def test_little_memory(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "PAIRS", 7)
    text = " ".join(random.Random(4).choices(["there", "zthing", "qa", "internazionally", "  ", "ééé"], k=500))
    encoder = bpe.Encoder(RANKS[FILES[0]])
    assert list(encoder(text)) == MODELS[FILES[0]].encode_ordinary(text)
    assert len(encoder.pieces) <= 5 and len(encoder.pairs) <= 7


def test_a_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError, match="no token for byte 7"):
        bpe.Encoder({bytes([b]): b for b in range(256) if b != 7})


def test_cases(spark, documents):
    long = "a" * 100_000 + " word" * 20_000 + " " * 5_000
    rows = [(None, "x y"), (1, None), (2, ""), (3, long), (4, " "), (4, " "), (5, "<|endoftext|>")]
    docs = documents(rows).withColumn("ids", F.lit("x")).withColumn("bytes", F.lit(1)).withColumn("d", F.lit(1))
    ids = bpe.encoded(docs)
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert got[1] == got[2] == []
    assert got[3] == MODELS[FILES[0]].encode_ordinary(long)
    assert got[5] == MODELS[FILES[0]].encode_ordinary("<|endoftext|>")
    back = [(str(r.doc_id), bytes(r.bytes).decode()) for r in bpe.decoded(ids).collect()]
    assert sorted(back) == sorted((str(i), t or "") for i, t in rows)
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.decoded(nothing).first().bytes is None
    empty = hashlib.sha256(b"").hexdigest()
    digest = {r.doc_id: r for r in bpe.digests(docs).collect()}
    assert digest[1][1:] == digest[2][1:] == (0, empty, empty)
    assert bpe.digests(documents([])).collect() == []
    assert bpe.encoded(documents([])).collect() == []


def test_tasks_of_a_worker_share_the_tables(spark, documents, tmp_path, monkeypatch):
    """A worker goes through the vocabulary once for ids and once for bytes, whatever tasks it gets."""
    log = tmp_path / "passes"
    counted = CountedRanks(RANKS[FILES[0]])
    counted.log = str(log)
    monkeypatch.setattr(bpe, "load_ranks", lambda path: counted)
    texts = [f"there {i} zthing internazionally" for i in range(24)]
    docs = documents(list(enumerate(texts))).repartition(24)
    assert docs.rdd.getNumPartitions() == 24
    got = {r.doc_id: r.n_tokens for r in bpe.digests(docs).collect()}
    assert got == {i: len(MODELS[FILES[0]].encode_ordinary(t)) for i, t in enumerate(texts)}
    passes = Counter(log.read_text().split())
    del passes[str(os.getpid())]
    assert passes and max(passes.values()) == 2


def test_only_positions_of_the_search_are_looked_up():
    """The bytes inside a token that is taken are not."""
    encoder = bpe.Encoder(RANKS[FILES[0]])
    starts = []

    class Counted(dict):
        def __getitem__(self, beginning):
            starts.append(beginning)
            return dict.__getitem__(self, beginning)

    encoder.reach = Counted(encoder.reach)
    piece = " " * 8 + "=" * 64
    assert encoder.merged(piece) == plain(piece.encode(), RANKS[FILES[0]])
    assert len(starts) < len(piece) // 4
