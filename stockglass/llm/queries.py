"""Registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockglass.llm import (
    bpe,
    dialogue,
    language,
    lloyd,
    minhash,
    mixing,
    personal,
    pieces,
    quality,
    secrets,
    simhash,
    topk,
    toxicity,
)
from stockglass.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(table(spark, sf_dir, "documents"))


def op3_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.QUERY_EVERY == 0)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place,
         sum(source_size) OVER ()::BIGINT AS total FROM sizes),
levels AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, place) AS rank,
         (total - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY source_size / weight, place
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lv
  FROM weighted),
level AS (SELECT arg_min(lv, rank) AS lv FROM levels WHERE lv * weight <= 3 * source_size),
targets AS (
  SELECT source, source_size,
         least(coalesce(level.lv * weight, 3 * source_size), 3 * source_size)::DOUBLE AS target
  FROM levels CROSS JOIN level),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies,
         target - copies * source_size AS budget FROM targets),
steps AS (
  SELECT source, h, sum(size)::BIGINT AS size,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto
  FROM sized GROUP BY source, h),
ends AS (
  SELECT s.source, s.h + CASE WHEN s.upto - b.budget <= b.budget - (s.upto - s.size)
                         THEN 1 ELSE 0 END AS below
  FROM steps s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
  WHERE s.upto - s.size < b.budget AND b.budget <= s.upto)
SELECT d.doc_id, d.size, b.source_size, b.target,
       d.size * (b.copies + CASE WHEN d.h < coalesce(e.below, 0) THEN 1 ELSE 0 END) AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN ends e ON d.source IS NOT DISTINCT FROM e.source
"""



def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.damage_reports(table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.vector_codes(table(spark, sf_dir, "embeddings"))


_NEAREST = """
n{round} AS (
  SELECT x.rn, x.part, x.v, arg_min(c.entry, {away} * 16 + c.entry) AS entry, min({away}) AS error
  FROM parts x JOIN c{round} c ON x.part = c.part GROUP BY x.rn, x.part, x.v)"""
_MOVED = """
c{after} AS (
  SELECT c.part, c.entry, coalesce(m.v, c.v) AS v
  FROM c{round} c LEFT JOIN (
    SELECT part, entry, list(x ORDER BY place) AS v FROM (
      SELECT part, entry, place, CAST(floor(sum(v[place]) / count(*)) AS BIGINT) AS x
      FROM n{round}, (SELECT unnest(range(1, width + 1)) AS place FROM size)
      GROUP BY part, entry, place) GROUP BY part, entry) m
  ON c.part = m.part AND c.entry = m.entry)"""
_AWAY = "CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
_ROUNDS = "".join(
    _NEAREST.format(round=i, away=_AWAY) + "," + _MOVED.format(round=i, after=i + 1) + ","
    for i in range(lloyd.ROUNDS)
)
OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER () AS rn,
         list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT max(len(v)) // 8 AS width FROM kept),
parts AS (
  SELECT rn, vec_id, part, v[part * width + 1 : part * width + width] AS v
  FROM kept, size, (SELECT unnest(range(8)) AS part)),
c0 AS (
  SELECT part, entry, v FROM (
    SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM parts)
  WHERE entry < 16),
{_ROUNDS}
{_NEAREST.format(round=lloyd.ROUNDS, away=_AWAY)},
books AS (
  SELECT sha256(string_agg(x, ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM (SELECT part, entry, array_to_string(v, ',') AS x FROM c{lloyd.ROUNDS})),
codes AS (
  SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         CAST(sum(error) AS BIGINT) AS error
  FROM n{lloyd.ROUNDS} GROUP BY rn)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       codebooks_sha256
FROM kept JOIN codes USING (rn) CROSS JOIN books
"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_top_k_search": op3_top_k_search,
    "op4_mix_sources": op4_mix_sources,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_secrets": op6_secrets,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_personal_data": op8_personal_data,
    "op9_language_id": op9_language_id,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_vector_codes": op12_vector_codes,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLE_SQL = {
    "op3_top_k_search": OP3_SQL,
    "op4_mix_sources": OP4_SQL,
    "op12_vector_codes": OP12_SQL,
}
