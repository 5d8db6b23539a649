"""Union by column name, and row numbers over the result."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from stockglass.functions.names import column
from stockglass.session import cut_lineage

# Where a row was read: file, offset of the split, and its place in the reading.
SPLIT_KEYS = ("_file_path", "_split_start")
READ_POSITION = "_read_position"


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, matched by column name; a column a part lacks is null there.

    Columns stand in the order of their first appearance.
    """
    if not parts:
        raise ValueError("nothing to combine")
    names = list(dict.fromkeys(name for part in parts for name in part.columns))

    def widened(part: DataFrame) -> DataFrame:
        own = set(part.columns)
        return part.select(
            *[
                column(n) if n in own else F.lit(None).cast("string").alias(n)
                for n in names
            ]
        )

    return reduce(DataFrame.unionByName, [widened(part) for part in parts])


def _rows_before(splits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``splits`` with ``rows_before``, the rows of all splits before in the order of ``keys``.

    Splits are cut into ranges. Sums run inside each range, and over the totals of
    the ranges, of which there are as many as shuffle partitions.
    """
    cut = splits.repartitionByRange(*keys).withColumn("range", F.spark_partition_id())
    cut = cut_lineage(cut)
    inside = Window.partitionBy("range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.orderBy("of_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(F.col("range").alias("of_range")).agg(F.sum("rows_of_split").alias("total"))
    totals = totals.withColumn("ranges_before", F.coalesce(F.sum("total").over(ranges), F.lit(0)))
    before = F.coalesce(F.sum("rows_of_split").over(inside), F.lit(0)) + F.col("ranges_before")
    return (
        cut.join(totals.drop("total"), F.col("range") == F.col("of_range"))
        .withColumn("rows_before", before)
        .drop("range", "of_range", "ranges_before", "rows_of_split")
    )


def with_row_index(
    df: DataFrame, split_keys: Sequence[str] = (), name: str = "row_index"
) -> DataFrame:
    """Numbers the rows 0..n-1 in the order of ``split_keys``, then reading position.

    ``split_keys`` tell where a row was read (file path, offset of the split); they
    are dropped. A row's number is the rows of earlier splits plus its distance from
    the first row of its own, so only one count per split is put in order, never the
    rows.

    Rows of a file set that know their reading position (``read_csv_set`` with
    ``with_split``) are read twice: once to count, which needs no column, and once to
    number them. Both readings see the same splits; should a file have changed in
    between, so that a split is not found again, the job fails. Rows of any other
    kind may come in another order when computed again, so a checkpoint fixes them
    first, at the price of one write and one read of all rows. How the offsets are
    joined is left to Spark.
    """
    keys = [*split_keys, "part_of_read"]
    if READ_POSITION in df.columns:
        marked = df
    else:
        marked = cut_lineage(df.withColumn(READ_POSITION, F.monotonically_increasing_id()))
    marked = marked.withColumn("part_of_read", F.shiftright(READ_POSITION, 33))
    splits = marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_of_split"), F.min(READ_POSITION).alias("first_position")
    )
    offsets = cut_lineage(_rows_before(splits, keys))
    position = F.col("rows_before") + F.col(READ_POSITION) - F.col("first_position")
    lost = F.raise_error("the files have changed since their rows were counted").cast("bigint")
    rest = [c for c in df.columns if c not in (*split_keys, READ_POSITION)]
    return marked.join(offsets, keys, "left").select(
        F.coalesce(position, lost).alias(name), *[column(c) for c in rest]
    )
