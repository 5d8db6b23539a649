"""Mix sources to target weights without sorting documents.

Every document has a 60-bit hash of its id. A source that gives ``r`` times its
size takes all documents ``floor(r)`` times, and once more those below a hash
threshold. The threshold comes from a histogram of sizes by source and leading
hash bits. Only the bucket in which the budget ends is cut finer, 12 bits at a
time. A smaller budget therefore takes a subset of what a larger one takes.

Cases: null or blank text has size 0 and takes 0; a null source is a source of
its own, last in order; a null id hashes as ''. Rows with the same id go
together, so the threshold never divides repeated rows. An empty table gives no
rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockglass.llm.common import WORD, materialize

HASH_BITS = 60
STEP_BITS = 12
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """The first 15 hex digits of the id's MD5, as a number."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """source, source_size -> also target: the total shared by weight, at most
    ``max_repeat`` times the source, what is over shared again.

    Sources fill up in order of size per weight. So the ones that stop are the
    first of that order, and the level of the others follows from running sums.
    One row per source passes through one task; sources are a configured list.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy(F.col("source_size") / F.col("weight"), "place")
    everything = W.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1)
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, W.unboundedFollowing)
    room = max_repeat * F.col("source_size")
    return (
        sizes.withColumn("place", F.row_number().over(in_order))
        .withColumn("weight", weight)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum(room).over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.sum("weight").over(onward))
        .withColumn("rank", F.row_number().over(by_ratio))
        .withColumn("open", F.when(F.col("level") * F.col("weight") <= room, F.col("rank")))
        .withColumn("level", F.min_by("level", "open").over(everything))
        .withColumn("share", F.coalesce(F.col("level") * F.col("weight"), room.cast("double")))
        .select("source", "source_size", F.least("share", room.cast("double")).alias("target"))
    )


def _end_bucket(histogram: DataFrame) -> DataFrame:
    """Of each source, the bucket in which its budget ends.

    histogram: source, bucket, size, lo, hi, budget; ``budget`` is what is left
    for these buckets. lo and hi are the least and the largest hash inside.
    """
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum("size").over(upto)
    return (
        histogram.withColumn("end", end)
        .withColumn("begin", F.col("end") - F.col("size"))
        .filter((F.col("begin") < F.col("budget")) & (F.col("budget") <= F.col("end")))
        .select("source", "bucket", "size", "lo", "hi", (F.col("budget") - F.col("begin")).alias("budget"))
    )


def mixing_plan(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """source, source_size, target, copies, below: a document is taken ``copies``
    times, and once more if its hash is under ``below``.

    sized: source, hash, size, a row per document. ``below`` falls on the side of
    the last document that comes nearer to the target.
    """

    def histogram(rows: DataFrame, shift: int, *more: Column) -> DataFrame:
        bucket = F.shiftright("hash", shift).alias("bucket")
        return rows.groupBy("source", bucket).agg(
            F.sum("size").alias("size"), F.min("hash").alias("lo"), F.max("hash").alias("hi"), *more
        )

    shift = HASH_BITS - STEP_BITS
    first = materialize(histogram(sized, shift), "mix-histogram")
    sizes = first.groupBy("source").agg(F.sum("size").alias("source_size"))
    repeat = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = materialize(
        source_targets(sizes, weights, max_repeat)
        .withColumn("copies", F.coalesce(repeat, F.lit(0)).cast("long"))
        .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")),
        "mix-targets",
    )

    def with_budget(rows: DataFrame, budgets: DataFrame) -> DataFrame:
        b = budgets.select(F.col("source").alias("b_source"), "budget")
        return rows.join(b, F.col("source").eqNullSafe(F.col("b_source"))).drop("b_source")

    ends = materialize(_end_bucket(with_budget(first, targets)), "mix-ends")
    while shift > 0 and not ends.filter("lo < hi").isEmpty():
        # Only the bucket where a budget ends is cut finer.
        inside = ends.select(
            F.col("source").alias("e_source"), F.col("bucket").alias("e_bucket"), F.col("budget")
        )
        at = F.shiftright("hash", shift) == F.col("e_bucket")
        rows = sized.join(inside, F.col("source").eqNullSafe(F.col("e_source")) & at)
        shift -= STEP_BITS
        finer = histogram(rows, shift, F.first("budget").alias("budget"))
        ends = materialize(_end_bucket(finer), "mix-ends")

    nearer = F.col("size") - F.col("budget") <= F.col("budget")
    last = ends.select(
        F.col("source").alias("e_source"), (F.col("lo") + nearer.cast("long")).alias("last")
    )
    plan = targets.join(last, F.col("source").eqNullSafe(F.col("e_source")), "left")
    below = F.coalesce("last", F.lit(0)).alias("below")
    return materialize(plan.select("source", "source_size", "target", "copies", below), "mix-plan")


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "source", id_hash(F.col("doc_id")).alias("hash"), word_count(F.col("text")).alias("size")
    )


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    p = plan.withColumnRenamed("source", "p_source")
    return rows.join(p, F.col("source").eqNullSafe(F.col("p_source")))


def _times() -> Column:
    return F.col("copies") + (F.col("hash") < F.col("below")).cast("long")


def mix_sizes(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """doc_id, size, source_size, target, taken: a row per document."""
    sized = materialize(sized_documents(docs), "mix-sized")
    rows = _with_plan(sized, mixing_plan(sized, weights, max_repeat))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _times()).alias("taken")
    )


def mix_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged."""
    sized = materialize(sized_documents(docs), "mix-sized")
    plan = mixing_plan(sized, weights, max_repeat)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, "source", id_hash(F.col("doc_id")).alias("hash"))
    repeated = F.explode(F.array_repeat("row", _times().cast("int"))).alias("row")
    return _with_plan(rows, plan).select(repeated).select("row.*")
