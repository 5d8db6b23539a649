"""Training rows for the classifiers that learn from the ``labels`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockglass.llm.common import held_out

HASH_BITS = 14  # of the hash that rows are counted by


def training_labels(labels: DataFrame, column: str, folds: int, fold: int, rows: int) -> DataFrame:
    """doc_id, label: at most ``rows`` labelled documents outside the held-out fold.

    They are those with the smallest hash of the id, so the choice does not
    depend on how the table is stored. A document with several labels counts as 1
    if one of them is 1; rows without an id or a label teach nothing.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    known = known.filter(~held_out(F.col("doc_id"), folds, fold))
    known = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    # Only rows below the hash that leaves enough of them are put in order.
    step = F.shiftright(F.xxhash64("doc_id"), 64 - HASH_BITS)
    counts = sorted(known.groupBy(step.alias("step")).count().collect())
    last, seen = None, 0
    for last, count in counts:
        seen += count
        if seen >= rows:
            break
    few = known.filter(step <= F.lit(last)) if seen >= rows else known
    return few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def training_documents(docs: DataFrame, chosen: DataFrame, *more: str) -> DataFrame:
    """text, the columns of ``chosen`` and ``more`` of the chosen documents.

    chosen: doc_id and what is known of it, a bounded number of rows, which is
    what makes the broadcast safe. Of several rows with one id the least counts.
    """
    ids = F.broadcast(chosen.withColumnRenamed("doc_id", "chosen_id"))
    rows = docs.select("doc_id", "text", *more).join(ids, F.col("doc_id") == F.col("chosen_id"))
    rest = [*more, *(c for c in chosen.columns if c != "doc_id")]
    least = F.min(F.struct("text", *rest)).alias("row")
    return rows.groupBy("doc_id").agg(least).select("row.*")
