"""Many CSV files with headers that may differ in order and columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stockglass.functions.names import column, header_names
from stockglass.operators.combine import READ_POSITION, SPLIT_KEYS
from stockglass.session import scratch_dir

# Where a row came from: file time, file path, reading position.
ARRIVAL = "_arrival"
_PLACES = "_places"

# Texts that mean "missing", as pandas reads them by default.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def header_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file_path``, as the metadata has it, and ``value``, the first line of each file.

    Spark reads the files as text, one per task, and each task stops after its
    first row.
    """

    # Defined here so that it travels with the task: workers need not have this package.
    def first_row(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    # A session of its own, so that no other query plans with these settings: no file
    # is split, and none shares a task with another.
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    apart.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    return (
        apart.read.text(paths)
        .select("_metadata.file_path", "value")
        .mapInArrow(first_row, "file_path string, value string")
        .withColumn("value", F.regexp_replace("value", "\r+$", ""))
    )


@dataclass(frozen=True)
class Layout:
    """How the files of a set are laid out.

    ``names``: all columns, in the order of their first appearance in the order of
    paths. ``width``: the most columns a header has. ``places``: a row per file, with
    the position of each of the names in its header, null where it has none; None if
    one header covers all files.
    """

    names: list[str]
    width: int
    places: DataFrame | None


def file_layout(spark: SparkSession, paths: str | Sequence[str]) -> Layout:
    """Reads the headers. The driver sees each distinct header once, never the files."""
    folder = scratch_dir(spark, "headers")
    header_lines(spark, paths).write.parquet(folder)
    lines = spark.read.schema("file_path string, value string").parquet(folder)
    found = lines.groupBy("value").agg(F.min("file_path").alias("first")).collect()
    headers = {r.value: header_names(r.value) for r in sorted(found, key=lambda r: r.first)}
    names = list(dict.fromkeys(name for header in headers.values() for name in header))
    width = max(map(len, headers.values()), default=0)
    if len({tuple(header) for header in headers.values()}) <= 1:
        return Layout(names, width, None)
    rows = [
        (value, [header.index(name) if name in header else None for name in names])
        for value, header in headers.items()
    ]
    known = spark.createDataFrame(rows, f"value string, {_PLACES} array<int>")
    return Layout(names, width, lines.join(known, "value").select("file_path", _PLACES))


def plain_path(uri: str) -> str:
    """A file's path as Spark's readers take it: the metadata has it encoded as in a URI,
    and a reader takes brackets and stars for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def file_arrival() -> Column:
    """Order of arrival of a row's file."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("path"),
    )


def row_arrival(of_file: Column) -> Column:
    """Order of arrival of a row. Not for streams, only for their batches."""
    return of_file.withField("row", F.monotonically_increasing_id())


def _fixed_splits(spark: SparkSession) -> SparkSession:
    """A session whose file splits do not depend on how many cores there are just now."""
    fixed = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        fixed.conf.set(key, spark.conf.get(key))
    cores = spark.sparkContext.defaultParallelism
    fixed.conf.set("spark.sql.files.minPartitionNum", spark.conf.get("spark.sql.files.minPartitionNum", None) or str(cores))
    return fixed


def read_csv_set(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    missing: Sequence[str] = MISSING_TEXTS,
    with_arrival: bool = False,
    with_split: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """All rows of all files, columns matched by name. Values stay text.

    A plain read of such files goes by position and mixes columns up. Here all files
    are read in one scan, by position, and each row's values are put in the places of
    its file's header. Files and places are joined by path: as a broadcast while Spark
    finds them small, else by a shuffle. So the plan is the same for any number of
    files, and grows with the columns only. A header must not span lines. Values may
    with ``multi_line``; files are then not split. ``with_split`` adds what
    :func:`stockglass.operators.combine.with_row_index` numbers rows by.
    """
    layout = file_layout(spark, paths)
    fields = [f"field_{i}" for i in range(layout.width)]
    reader = _fixed_splits(spark).read if with_split else spark.read
    rows = (
        reader.schema(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    extra: dict[str, Column] = {}
    if with_arrival:
        extra[ARRIVAL] = row_arrival(file_arrival())
    if with_split:
        split = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        extra |= dict(zip(SPLIT_KEYS, split)) | {READ_POSITION: F.monotonically_increasing_id()}

    def cleaned(value: Column) -> Column:
        return F.when(~value.isin(*missing), value) if missing else value

    tail = [value.alias(name) for name, value in extra.items()]
    if layout.places is None:
        named = [cleaned(F.col(f)).alias(n) for f, n in zip(fields, layout.names)]
        return rows.select(*named, *tail)
    # What tells where a row was read is computed before the join, which may move rows.
    values = F.array(*[F.col(f) for f in fields]).alias("_values")
    placed = rows.select(values, F.col("_metadata.file_path").alias("file_path"), *tail)
    placed = placed.join(layout.places, "file_path")
    named = [
        cleaned(F.get("_values", F.get(_PLACES, F.lit(i)))).alias(n) for i, n in enumerate(layout.names)
    ]
    return placed.select(*named, *extra)


def read_station_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Station files for loading: nothing but an empty field is missing, rows know their arrival."""
    return read_csv_set(spark, paths, missing=(), with_arrival=True)
