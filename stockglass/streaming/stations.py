"""Loads station files of any header as they arrive."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stockglass.functions.names import header_names
from stockglass.operators.climate import Years
from stockglass.plans.stations import load_stations
from stockglass.schemas import STATION_DATE, STATION_YEAR
from stockglass.sources.csv_set import header_lines, plain_path, read_station_files

REPORT = "rows bigint, rejected bigint, duplicates bigint, files bigint, quarantined bigint"
QUARANTINE = "path string, reason string"
FILES_PER_BATCH = 1000


def arriving_files(
    spark: SparkSession, source: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """``path`` of each file as it arrives, as the metadata has it. The files are not read.
    One without a byte does not arrive."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select(F.col("_metadata.file_path").alias("path"))
    )


def header_fault(header: str | None) -> str | None:
    """Why a file with this header line can't be loaded; None if it can."""
    if header is None:
        return "no header"
    try:
        names = header_names(header)
    except ValueError as error:
        return str(error)
    lacking = [name for name in (STATION_YEAR, STATION_DATE) if name not in names]
    return f"no column {', '.join(lacking)}" if lacking else None


def sort_files(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """The files that can be loaded, and (path, reason) of the others. Reads first lines only.

    The columns of all files together become attributes, so files whose names differ
    from the others' only in case are put aside too: those of the later path.
    """
    headers: dict[str, str] = {}
    if paths:
        lines = header_lines(spark, [plain_path(p) for p in paths]).collect()
        headers = {r.file_path: r.value for r in lines}
    good: list[str] = []
    bad: list[tuple[str, str]] = []
    spelled: dict[str, str] = {}
    for path in sorted(paths):
        fault = header_fault(headers.get(path))
        names = [] if fault else header_names(headers[path])
        other = next((n for n in names if spelled.get(n.lower(), n) != n), None)
        if other is not None:
            fault = f"columns {spelled[other.lower()]!r} and {other!r} differ only in case"
        if fault:
            bad.append((path, fault))
        else:
            good.append(path)
            spelled |= {n.lower(): n for n in names}
    return good, bad


def start_station_load(
    spark: SparkSession,
    source: str,
    years: Years,
    items_path: str,
    checkpoint: str,
    *,
    rejects_path: str | None = None,
    reports_path: str | None = None,
    quarantine_path: str | None = None,
    first_batch_id: int = 0,
    files_per_batch: int = FILES_PER_BATCH,
    available_now: bool = True,
) -> StreamingQuery:
    """Upserts the wanted years of every arriving file into the item log.

    The stream carries paths, so a file is read by its own header, whatever the
    others have: columns are matched by name. A batch holds ``files_per_batch`` files
    at most, whose paths pass the driver. A file that can't be loaded, for want of a
    header or of a key column, is quarantined: its path and the reason are kept and
    the other files are loaded.

    Batch numbers start at ``first_batch_id``: a new checkpoint over an
    existing log must start above it (:func:`next_batch_id`). A batch that is
    run again after a failure sees the same files and overwrites only itself. A batch
    without a wanted row is an empty batch. Rejected rows, quarantined files and one
    report a batch are kept, beside the log (``-rejects``, ``-quarantine`` and
    ``-reports``) unless paths are given.
    """
    beside = items_path.rstrip("/")
    rejects, reports = rejects_path or f"{beside}-rejects", reports_path or f"{beside}-reports"
    quarantine = quarantine_path or f"{beside}-quarantine"

    def load(batch: DataFrame, batch_number: int) -> None:
        session, batch_id = batch.sparkSession, first_batch_id + batch_number
        # A file whose name looks like a pattern comes more than once.
        paths = [r.path for r in batch.distinct().collect()]
        load_files(session, paths, years, items_path, batch_id, rejects, reports, quarantine)

    writer = (
        arriving_files(spark, source, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def load_files(
    spark: SparkSession,
    paths: Sequence[str],
    years: Years,
    items_path: str,
    batch_id: int,
    rejects: str,
    reports: str,
    quarantine: str,
) -> None:
    """Loads files as one batch. Loading them again changes nothing."""
    good, bad = sort_files(spark, paths)
    counts = (0, 0, 0)
    if good:
        rows = read_station_files(spark, [plain_path(p) for p in good])
        counts = astuple(load_stations(rows, years, items_path, batch_id, rejects))
    for path, rows, schema in (
        (quarantine, bad, QUARANTINE),
        (reports, [(*counts, len(paths), len(bad))], REPORT),
    ):
        if rows:
            kept = spark.createDataFrame(rows, schema)
            kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
