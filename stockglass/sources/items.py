"""The keyed item table: ``(year, date)`` -> attributes, kept as a log of batches.

Plain Parquet cannot be changed in place while it is read, so every batch
writes its own ``batch_id=`` directory, by year inside, holding each key at most
once. Writing a batch again replaces the whole directory, years it no longer has
included. Readers see, per key, the whole item of the highest batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stockglass.operators.climate import ITEM_KEYS, last_per_key
from stockglass.sources.files import write_snapshot

LOG_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("batch_id", T.LongType()),
        T.StructField("year", T.StringType()),
    ]
)


def ensure_items_table(spark: SparkSession, name: str, path: str) -> None:
    """Registers the log under ``name`` unless a table of that name exists.

    After a load :func:`sync_items_table` makes its batches known.
    """
    quoted_path = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ("
        "date STRING, attributes MAP<STRING, STRING>, year STRING, batch_id BIGINT"
        f") USING parquet PARTITIONED BY (batch_id, year) LOCATION '{quoted_path}'"
    )


def sync_items_table(spark: SparkSession, name: str) -> None:
    """Makes new years and batches known to the catalog and forgets those that are gone."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def upsert_items(items: DataFrame, path: str, batch_id: int) -> None:
    """Puts whole items; the last one of a key wins, in the batch and over earlier batches.
    A batch appears, or takes the place of one written before, when it is whole."""
    writer = last_per_key(items).hint("rebalance", "year").write.partitionBy("year")
    write_snapshot(items.sparkSession, writer, batch_path(path, batch_id))


def count_batch(spark: SparkSession, path: str, batch_id: int) -> int:
    """How many items a batch holds, from the file footers."""
    return read_log(spark, path).where(F.col("batch_id") == batch_id).count()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The batches as written; empty if nothing has been written yet."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def latest_items(log: DataFrame) -> DataFrame:
    """The current item per key. Filters on ``year`` and ``date`` pass through to the scan."""
    return (
        log.groupBy(*ITEM_KEYS)
        .agg(F.max_by("attributes", "batch_id").alias("attributes"))
        .select(*ITEM_KEYS, "attributes")
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return latest_items(read_log(spark, path))


def next_batch_id(spark: SparkSession, path: str) -> int:
    """One above the highest batch in the log. Opens its files, but reads no column."""
    highest = read_log(spark, path).agg(F.max("batch_id")).first()[0]
    return 0 if highest is None else highest + 1


def compact_items(spark: SparkSession, path: str, target: str) -> None:
    """Writes the current items as the only batch of a new log at ``target``."""
    keep = next_batch_id(spark, path) - 1
    upsert_items(read_items(spark, path), target, max(keep, 0))
