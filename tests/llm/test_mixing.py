from pyspark.sql import functions as F

from stockglass.llm import mixing, queries


def test_equals_sql(same_as_sql):
    same_as_sql(queries.op4_mix_sources, queries.OP4_SQL)


def _mix(df):
    return {r.doc_id: r for r in mixing.mix_sizes(df).collect()}


def test_targets_stop_at_three_sizes_and_the_rest_is_shared_again(documents):
    rows = [(i, "w " * 10, None, "a") for i in range(90)]
    rows += [(100 + i, "w " * 10, None, "b") for i in range(10)]
    rows += [(200, "w " * 10, None, None)]
    got = _mix(documents(rows))
    # 1,010 words at weights 1, 2, 3; b stops at 300, null at 30, a takes the rest
    assert {r.target for r in got.values()} == {680.0, 300.0, 30.0}
    assert all(got[i].taken == 30 for i in (*range(100, 110), 200))
    assert sum(got[i].taken for i in range(90)) == 680


def test_taken_words_come_near_the_target(spark, documents):
    rows = [(i, "w " * (1 + i % 37), None, f"s{i % 3 if i % 2 else 0}") for i in range(3000)]
    result = mixing.mix_sizes(documents(rows))
    by_source = result.groupBy("source_size").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target")
    )
    assert all(abs(r.taken - r.target) <= 37 for r in by_source.collect())
    assert result.filter("taken > 3 * size").isEmpty()


def test_a_smaller_budget_takes_a_subset(documents):
    docs = documents([(i, "w " * 5, None, "ab"[i % 2]) for i in range(400)])
    small = {i for i, r in _mix(docs).items() if i % 2 == 0 and r.taken}
    large = {
        r.doc_id
        for r in mixing.mix_sizes(docs, weights=(5, 6)).collect()
        if r.doc_id % 2 == 0 and r.taken
    }
    assert small and small < large


def test_nulls_blanks_repeated_rows_and_clashing_columns(documents):
    docs = documents(
        [(None, None), (1, ""), (2, " \t\n"), (3, "a b", None, "s"), (3, "a b", None, "s")]
    )
    docs = docs.withColumn("size", F.lit("x")).withColumn("hash", F.lit(1)).withColumn("row", F.lit(2))
    got = mixing.mix_sizes(docs).collect()
    assert [r.size for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))] == [0, 0, 2, 2, 0]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.filter("doc_id = 3").count() in (2, 4)


def test_a_long_text_is_counted_whole(documents):
    (row,) = mixing.mix_sizes(documents([(1, "word " * 300_000, None, "s")])).collect()
    assert row.size == row.taken == 300_000


def test_empty_table(documents):
    assert mixing.mix_sizes(documents([])).collect() == []
    assert mixing.mix_documents(documents([])).collect() == []
