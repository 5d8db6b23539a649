import hashlib
import random
import re

from pyspark.sql import functions as F

from stockglass.llm import personal, queries
from tests.llm.conftest import DATA


def luhn(digits):
    doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _digits(text):
    return re.sub("[^0-9]", "", text)


FORMS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(_digits(m)) <= 15),
)


def plain(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern, good in FORMS
        if kind != "email" or "@" in (text or "")
        for m in re.finditer(pattern, text or "")
        if good(m[0])
    ]


def _check(rows, texts):
    """texts: by id; base spans must be those of the definition."""
    for r in rows:
        wanted = plain(texts[r.doc_id])
        assert [s for s in r.spans.split(",") if s and not s.startswith("context")] == wanted
        assert r.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        counts = [r.n_email, r.n_ip, r.n_card, r.n_phone]
        assert counts == [sum(s.startswith(k) for s in wanted) for k in personal.KINDS]


def test_query_keeps_all_base_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.op8_personal_data(spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    _check(got, texts)


def test_base_forms_of_random_texts(documents):
    rng = random.Random(6)
    parts = ["a", "b.c", "@", ".", "-", " ", "1", "25", "255", "256", "0", "4111111111111111", "+", "+1", "(", ")", "é", "𝒳", "%", "_", "\n", "007"]
    texts = {i: "".join(rng.choices(parts, k=rng.randint(0, 40))) for i in range(1500)}
    got = personal.personal_data(documents(list(texts.items()))).collect()
    assert len(got) == len(texts)
    _check(got, texts)


def test_contexts_discover_what_no_form_covers(documents):
    rows = [(i, f"Some words here, contact: user{i}@mail.example.com please") for i in range(9)]
    rows += [(20, "Write today, contact: K-77-1234x please. Year 1999 was words here"), (21, "words here 12345 and here")]
    rows += [(30 + i, "some words please here and there") for i in range(30)]
    got = {r.doc_id: r for r in personal.personal_data(documents(rows)).collect()}
    assert got[20].spans == "context:22:32" and got[20].n_context == 1
    assert rows[9][1][22:32] == "K-77-1234x"
    assert got[21].spans == "" and got[3].n_email == 1 and got[3].n_context == 0


def test_a_label_that_never_stands_beside_a_seed_is_reached(documents):
    rows = [(i, f"Some words here, contact: user{i}@mail.example.com please") for i in range(40)]
    rows += [(100 + i, f"Write today, contact: K-77-{i}x please") for i in range(20)]
    rows += [(200 + i, f"for travel passport: K-77-{i}x is needed") for i in range(20)]
    rows += [(300, "for travel passport: Z-99-1234y is needed"), (301, "there were 12345 words here")]
    got = {r.doc_id: r for r in personal.personal_data(documents(rows)).collect()}
    assert got[300].spans == "context:21:31" and rows[-2][1][21:31] == "Z-99-1234y"
    assert got[200].n_context == 1 and got[301].spans == ""


def test_redaction(documents):
    rows = [(1, "a@b.cd, 10.0.0.1"), (2, None), (3, "plain"), (3, "plain"), (4, "é: 4111111111111111 x")]
    rows += [(None, "z x@y.zz"), (5, "+1 (555) 123-4567")]
    docs = documents(rows).withColumn("spans", F.lit("s")).withColumn("row", F.lit(1)).withColumn("h", F.lit(2))
    kept = personal.redacted(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("1", "[EMAIL], [IP]"),
        ("2", "None"),
        ("3", "plain"),
        ("3", "plain"),
        ("4", "é: [CARD] x"),
        ("5", "[PHONE]"),
        ("None", "z [EMAIL]"),
    ]


def test_cases(documents):
    # The plain search reads such runs again and again, so they are not as long as they could be.
    digits, numbers = "1" * 9000, "10.0.0.1 " * 5000
    local = "a" * 200_000 + " 1"
    texts = {1: None, 2: "", 3: digits, 4: numbers, 5: local, None: "q@w.er", 6: "+" * 9 + "1" * 9000, 7: "1 " * 20_000}
    docs = documents(list(texts.items()) * 2).withColumn("email", F.lit("x")).withColumn("text_hash", F.lit(1))
    got = personal.personal_data(docs).collect()
    assert len(got) == 2 * len(texts)
    _check(got, texts)
    assert personal.personal_data(documents([])).collect() == []
    assert personal.redacted(documents([])).collect() == []


def test_no_python_in_the_plans(spark):
    found = personal.found_spans(spark.read.parquet(f"{DATA}/documents.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
