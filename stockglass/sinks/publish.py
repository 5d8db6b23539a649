"""Archive and current snapshots, and their catalog tables.

Archive partitions lie at ``{archive}/weekly_summary={date}``, dimension copies
in folders of their own: Parquet and CSV under one root would not be readable
as one table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from stockglass.schemas import DIMENSION_TABLES
from stockglass.sinks.copies import copy_files
from stockglass.sources.files import qualified, write_snapshot
from stockglass.sources.footers import discover
from stockglass.sources.landing import landing_path

SUMMARY = "weekly_summary"


def _write_parquet(df: DataFrame, path: str, files: int | None) -> None:
    out = df if files is None else df.repartition(files)
    write_snapshot(df.sparkSession, out.write.option("compression", "gzip"), path)


def archive_path(archive: str, date: str) -> str:
    return f"{archive.rstrip('/')}/{SUMMARY}={date}"


def current_path(result: str) -> str:
    return f"{result.rstrip('/')}/{SUMMARY}"


def publish_archive(df: DataFrame, archive: str, date: str, files: int | None = None) -> str:
    """Writes one day's snapshot over an earlier one of that day; other days stay.
    It takes the earlier one's place when it is whole.

    ``files`` fixes the number of files; without it Spark sizes them.
    """
    path = archive_path(archive, date)
    _write_parquet(df, path, files)
    return path


def publish_current(
    spark: SparkSession, archive: str, date: str, result: str, files: int | None = None
) -> str:
    """Makes an archived day the current snapshot. Reads the archive, computes nothing anew.
    Until it is written the snapshot before it stays."""
    path = current_path(result)
    _write_parquet(spark.read.parquet(archive_path(archive, date)), path, files)
    return path


def dimension_targets(archive: str, result: str, table: str, date: str) -> tuple[str, str]:
    """Where the copies of a day's dimension extract go: archive and current."""
    return landing_path(archive, table, date), f"{result.rstrip('/')}/{table}.csv"


def publish_dimensions(
    spark: SparkSession,
    landing: str,
    date: str,
    archive: str,
    result: str,
    tables: Sequence[str] = DIMENSION_TABLES,
) -> DataFrame:
    """Copies the day's dimension extracts, byte for byte, to
    ``{archive}/{table}_{date}.csv`` and ``{result}/{table}.csv``: a file as a file, a
    folder as a folder. One row per file, with the SHA-256 of source and copy."""
    targets = {
        target: landing_path(landing, table, date)
        for table in tables
        for target in dimension_targets(archive, result, table, date)
    }
    return copy_files(spark, targets)


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Registers Parquet files as a table, columns and partitions found in the files.

    The columns are those of all files together: one that only some days have is null on
    the others, and of types that differ the table has the widest. A table of that name
    over another path, or with other columns than the files have now, is registered
    anew; its files stay where they are.
    """
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)
    schema, partitions = discover(spark, path)
    if spark.catalog.tableExists(name) and not _same_table(spark, name, path, schema):
        spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        by = f" PARTITIONED BY ({', '.join(map(_quoted, partitions))})" if partitions else ""
        location = qualified(spark, path).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{location}'")
    if partitions:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _same_table(spark: SparkSession, name: str, path: str, schema: T.StructType) -> bool:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    # Spark names both folders in full.
    if not details or details[0].data_type.rstrip("/") != qualified(spark, path):
        return False
    return {(f.name, f.dataType) for f in schema} == {
        (f.name, f.dataType) for f in spark.table(name).schema
    }
