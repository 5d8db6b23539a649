"""Dated extracts in the landing area."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StructType

from stockglass.functions.names import column

NULL_TEXT = "\x00"


def landing_path(base: str, table: str, date: str) -> str:
    return f"{base.rstrip('/')}/{table}_{date}.csv"


def read_landing(
    spark: SparkSession,
    base: str,
    table: str,
    date: str,
    schema: StructType | None = None,
    *,
    multi_line: bool = False,
    checked: Observation | None = None,
) -> DataFrame:
    """One day's extract: comma separated, with a header line. Columns go by name.

    With a schema its columns are picked and converted; a value that does not
    fit its type becomes null, and :func:`misfits` finds the row. ``checked`` counts such
    rows, as ``misfits``, while they are read. Without a schema all
    columns come as text. An extract of several files must have the same header in
    each, which Spark checks. ``multi_line`` lets values span lines.
    """
    path = landing_path(base, table, date)
    reader = spark.read.option("header", True).option("sep", ",").option("escape", '"')
    # A text no file holds stands for null, or else "" would become null as well.
    reader = reader.option("nullValue", NULL_TEXT).option("multiLine", multi_line)
    header = reader.csv(path).schema
    rows = reader.schema(header).option("enforceSchema", False).csv(path)
    if schema is None:
        return rows
    if checked is not None:
        rows = rows.observe(checked, F.count_if(F.size(misfit_names(schema)) > 0).alias("misfits"))
    return rows.select(*[typed(column(f.name), f.dataType).alias(f.name) for f in schema])


def typed(text: Column, kind: DataType) -> Column:
    """The text as a value of its type, null if it is none; ``200.0`` is a whole number."""
    if isinstance(kind, IntegralType):
        number = text.try_cast(DecimalType(38, 10))
        return F.when(number == F.floor(number), number).try_cast(kind)
    return text.try_cast(kind)


def misfit_names(schema: StructType) -> Column:
    """The names of the columns of a text extract whose value their type can't hold."""

    def misfit(name: str, kind: DataType) -> Column:
        text, value = F.trim(column(name)), typed(column(name), kind)
        lost = value.isNull()
        if isinstance(kind, DecimalType):
            lost = lost | ~text.try_cast("double").eqNullSafe(value.cast("double"))
        return F.when((text != "") & lost, F.lit(name))

    return F.array_compact(F.array(*[misfit(f.name, f.dataType) for f in schema]))


def misfits(rows: DataFrame, schema: StructType) -> DataFrame:
    """The rows of a text extract with a value that its type can't hold, and ``misfits``,
    the names of those columns. Digits beyond a decimal's scale count too."""
    return rows.withColumn("misfits", misfit_names(schema)).where(F.size("misfits") > 0)


_LISTING = "path string, length bigint, modificationTime timestamp"


def list_landing(spark: SparkSession, pattern: str, *, below: bool = False) -> DataFrame:
    """Files matching a glob as rows; none if nothing matches. File contents are not read.
    ``below`` lists all files in the folders below too."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", below).load(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LISTING)
    return files.select("path", "length", "modificationTime")
