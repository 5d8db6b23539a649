import duckdb
import pytest
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.001"
DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows."""

    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def same_as_sql(spark):
    """Asserts that a query equals its SQL over the smallest given tables."""

    def check(query, sql, digits=9):
        def rounded(row):
            return repr(tuple(round(v, digits) if isinstance(v, float) else v for v in row))

        df = query(spark, DATA)
        connection = duckdb.connect()
        for t in ("documents", "embeddings", "labels", "benchmark"):
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        cursor = connection.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        places = [columns.index(c) for c in df.columns]
        wanted = [rounded([r[i] for i in places]) for r in cursor.fetchall()]
        got = [rounded(r) for r in df.collect()]
        assert got and sorted(got) == sorted(wanted)

    return check
