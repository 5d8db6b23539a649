import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockglass.llm import pieces, queries
from tests.llm.conftest import DATA

MODEL = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
VOCABULARY = pieces.load_vocabulary()


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(VOCABULARY)


def test_query_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.op2_sentencepiece(spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.ids == MODEL.encode(texts[r.doc_id]) and r.n_ids == len(r.ids)
        assert r.round_trip and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@given(st.text() | st.text("ab  ▁\n\t<>s0xAé梦ing"))
@settings(deadline=None, max_examples=300)
def test_any_text(text):
    ids = pieces.Encoder(VOCABULARY)(text)
    assert list(ids) == MODEL.encode(text)
    assert pieces.decode(ids, VOCABULARY.texts) == MODEL.decode(list(ids))


@given(st.text("ab ▁thein\nré", max_size=300))
@settings(deadline=None, max_examples=200)
def test_one_search_of_the_text_equals_those_of_its_parts(text):
    marked = pieces.BLANK + text.replace(" ", pieces.BLANK)
    e = pieces.Encoder(VOCABULARY)
    assert list(e.search(marked)) == list(e(text)) or not text


def test_the_window_stays_small(encoder, monkeypatch):
    sizes = []
    converged = encoder._converged
    monkeypatch.setattr(encoder, "_converged", lambda s, b, e: sizes.append(len(s)) or converged(s, b, e))
    rng = random.Random(3)
    text = "".join(rng.choices("thereinganoes", k=60_000))
    assert list(encoder.search(pieces.BLANK + text)) == MODEL.encode(text)
    assert max(sizes) <= 8 * VOCABULARY.longest


def test_little_memory(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "PARTS", 7)
    monkeypatch.setattr(pieces, "STRETCH", 6)
    text = " ".join(random.Random(4).choices(["there", "thing", "a", "internationally", "  ", "ééé"], k=500))
    assert list(pieces.Encoder(VOCABULARY)(text)) == MODEL.encode(text)


def test_every_part_is_searched_once_and_long_ones_are_not_remembered(monkeypatch):
    e, searched = pieces.Encoder(VOCABULARY), []
    search = e.search
    monkeypatch.setattr(e, "search", lambda text: searched.append(text) or search(text))
    long = "thereinganoes" * 20
    text = f"there thing there, {long} thing, {long}"
    assert list(e(text)) == list(e(text)) == MODEL.encode(text)
    short = [s for s in searched if len(s) <= pieces.STRETCH]
    assert "▁there" in short and len(short) == len(set(short))
    assert max(map(len, [*e.parts, *e.stretches])) <= pieces.STRETCH
    assert "".join(dict.fromkeys(searched)).count(long) == 1 and len(searched) - len(short) == 4


def test_a_vocabulary_without_cuts(encoder):
    whole = pieces.Encoder(VOCABULARY)
    whole.v = pieces.Vocabulary(VOCABULARY.scores, VOCABULARY.ids, VOCABULARY.byte_ids, VOCABULARY.texts)
    whole.v.cuttable = False
    text = "one two  three\nfour " * 50
    assert list(whole(text)) == list(encoder(text))


def test_cases(spark, documents):
    long = "a" * 100_000 + " word" * 20_000
    rows = [(None, "x y"), (1, None), (2, ""), (3, long), (4, " "), (4, " ")]
    docs = documents(rows).withColumn("ids", F.lit("x")).withColumn("r", F.lit(1))
    got = {r.doc_id: r for r in pieces.round_trips(docs).collect()}
    assert got[1].ids == got[2].ids == [] and got[1].round_trip
    assert got[3].ids == MODEL.encode(long) and got[3].round_trip and got[None].round_trip
    back = pieces.decoded(pieces.encoded(docs)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert pieces.round_trips(documents([])).collect() == []
    assert pieces.decoded(pieces.encoded(documents([]))).collect() == []


def test_paths_that_meet_late(encoder):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for tail in ("a" * 40, "qwertzuiop" * 50, "er" * 40):
        text = "(LMGUCVRGMRDTFDPPDDFEQLLIOMOSPOPlafebewepptrirorer" + tail
        assert list(encoder(text)) == model.encode(text)
