"""Station jobs: combine yearly files, load items, extract a range."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockglass.operators.climate import (
    Years,
    attribute_names,
    dated_rows,
    range_query,
    to_items,
    to_rejects,
    to_wide,
)
from stockglass.operators.combine import SPLIT_KEYS, with_row_index
from stockglass.sinks.export import export_csv
from stockglass.sources.csv_set import read_csv_set, read_station_files
from stockglass.sources.items import (
    count_batch,
    ensure_items_table,
    read_items,
    sync_items_table,
    upsert_items,
)
from stockglass.sources.landing import list_landing


@dataclass(frozen=True)
class LoadReport:
    """``rows`` wanted; ``rejected`` had no readable date, ``duplicates`` gave way to a
    later row of their key."""

    rows: int
    rejected: int
    duplicates: int


def combine_stations(
    spark: SparkSession, pattern: str, target: str, *, row_index: bool = False
) -> int:
    """Writes all files matching ``pattern`` as one CSV table; returns its number of rows.

    ``row_index`` adds a 0-based first column without a name. Without any file
    nothing is written, unless rows are to be numbered: that is an error.
    """
    if list_landing(spark, pattern).isEmpty():
        if row_index:
            raise FileNotFoundError(pattern)
        return 0
    if not row_index:
        return export_csv(read_csv_set(spark, pattern), target)
    rows = with_row_index(read_csv_set(spark, pattern, with_split=True), SPLIT_KEYS)
    return export_csv(rows, target, unnamed="row_index")


def load_stations(
    rows: DataFrame,
    years: Years,
    items_path: str,
    batch_id: int,
    rejects_path: str | None = None,
) -> LoadReport:
    """Upserts the rows of the wanted years as one batch, which may be empty, and counts.

    The counts are an aggregate of their own over two columns: adaptive execution
    can drop an observation together with an empty plan. Rejected rows are written
    to ``rejects_path``, which reads the input once more, but only if there are any.
    """
    dated = dated_rows(rows, years)
    bad = F.count_if(F.col("station_day").isNull())
    seen, rejected = dated.agg(F.count(F.lit(1)), bad).first()
    if rejects_path and rejected:
        to_rejects(dated).write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
    upsert_items(to_items(dated), items_path, batch_id)
    stored = count_batch(rows.sparkSession, items_path, batch_id)
    return LoadReport(seen, rejected, seen - rejected - stored)


def load_station_file(
    spark: SparkSession,
    path: str,
    years: Years,
    items_path: str,
    batch_id: int,
    *,
    table: str | None = None,
    rejects_path: str | None = None,
) -> LoadReport:
    """Loads the years of one file (or set of files), creating the item table first if named."""
    if table:
        ensure_items_table(spark, table, items_path)
    report = load_stations(
        read_station_files(spark, path), years, items_path, batch_id, rejects_path
    )
    if table:
        sync_items_table(spark, table)
    return report


def extract_range(
    spark: SparkSession,
    items_path: str,
    year: int | str,
    start: str,
    end: str,
    target: str,
    *,
    single_file: bool = True,
) -> int:
    """Writes the items of a date range as CSV, every attribute that occurs a column.

    One year has at most 366 days, so a single sorted file is safe unless an
    attribute named ``date`` takes the place of the key; then say
    ``single_file=False``. Returns the number of rows; for 0 no file is written.
    """
    found = range_query(read_items(spark, items_path), year, start, end)
    names = attribute_names(found, empty_items=True)
    if not names:
        return 0
    wide = to_wide(found, [n for n in names if n is not None])
    return export_csv(
        wide, target, single_file=single_file, order_by=["date"], known_rows=True
    )
