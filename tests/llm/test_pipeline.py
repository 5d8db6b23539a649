"""The pipeline stage by stage against brute force on the smallest given tables."""

import hashlib
from collections import Counter

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from stockglass.llm import language, pieces, queries
from tests.llm import test_personal, test_simhash
from tests.llm.conftest import DATA, DOCUMENT

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows in and out of each stage, each out written and read again as the next in."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = [(-1, "123 --", None, None, 6), (-2, None, None, None, None), (-3, "Call +1 (555) 123-4567 and so on and so on", "en", None, 40)]
    docs = docs.unionAll(spark.createDataFrame(odd, DOCUMENT)).cache()
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, DATA).write.parquet(path)
        out = spark.read.parquet(path)
        assert name == "sentencepiece" or out.columns == docs.columns
        found[name] = docs.collect(), out.collect()
        docs = out
    return found


def test_names_and_order():
    assert list(STAGES) == ["language_id", "near_dedup", "personal_data", "mixing", "sentencepiece"]


def test_language_id_keeps_what_has_a_language(stages):
    before, after = stages["language_id"]
    predict = language.Predictor(language.LanguageModel([["en"]]))
    letters = {r.doc_id for r in before if predict.count(r.text).sum()}
    assert {r.doc_id for r in after} == letters


def test_near_dedup_keeps_the_first_of_each_group(stages):
    before, after = stages["near_dedup"]
    label = test_simhash.plain_components([(r.doc_id, test_simhash.plain_fingerprint(r.text)) for r in before])
    assert Counter(after) == Counter(r for r in before if label[r.doc_id] == r.doc_id)


def test_personal_data_is_replaced(stages):
    before, after = stages["personal_data"]
    wanted = Counter()
    for r in before:
        spans = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in test_personal.plain(r.text)))
        text, at = "", 0
        for start, end, kind in spans:
            if start >= at:
                text += r.text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        wanted[(r.doc_id, text + r.text[at:], r.lang, r.source, r.n_chars)] += 1
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in after) == wanted
    assert any("[PHONE]" in r.text for r in after)


def test_personal_data_known_by_its_context_is_replaced(spark, documents):
    rows = [(i, f"Some words here, contact: user{i}@mail.example.com please") for i in range(9)]
    rows += [(20, "Write today, contact: K-77-1234x please"), (21, "words here 12345 and here")]
    kept = {r.doc_id: r.text for r in STAGES["personal_data"](spark, documents(rows), DATA).collect()}
    assert kept == {
        **{i: "Some words here, contact: [EMAIL] please" for i in range(9)},
        20: "Write today, contact: [CONTEXT] please",
        21: "words here 12345 and here",
    }


def test_mixing_repeats_documents_as_the_sql_says(stages, tmp_path, spark):
    before, after = stages["mixing"]
    spark.createDataFrame(before, DOCUMENT).write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    taken = connection.execute(f"SELECT doc_id, size, taken FROM ({queries.OP4_SQL})").fetchall()
    wanted = {i: n // size for i, size, n in taken if n}
    assert Counter(r.doc_id for r in after) == wanted
    assert set(after) <= set(before)


def test_sentencepiece_gives_the_library_s_ids(stages):
    before, after = stages["sentencepiece"]
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = Counter((r.doc_id, tuple(model.encode(r.text)), digest(r.text)) for r in before)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in after) == wanted
    assert all(r.round_trip for r in after)


def test_run_equals_the_stages_and_takes_no_rows(spark, tmp_path):
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == ["doc_id", "n_ids", "ids", "decoded_sha256", "round_trip"] and got.count() > 100
    spark.createDataFrame([], DOCUMENT).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
