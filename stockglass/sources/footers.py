"""The columns of Parquet files that were written over time, from their footers."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stockglass.sources.files import opener
from stockglass.sources.landing import list_landing

FOOTER_KEY = b"org.apache.spark.sql.parquet.row.metadata"

# From narrow to wide; each can be read as any that follows.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both can be read as without loss."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    pair = {a, b}
    if pair == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    if T.DoubleType() in pair and pair & set(_WHOLE[:3]):
        return T.DoubleType()
    if pair == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    decimals = [
        t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[t], 0)
        for t in (a, b)
        if isinstance(t, T.DecimalType) or t in _DIGITS
    ]
    if len(decimals) == 2:
        scale = max(t.scale for t in decimals)
        whole = max(t.precision - t.scale for t in decimals)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """All columns of both, each in the wider of its types, in the order of first appearance."""
    fields = {f.name.lower(): f for f in a}
    for f in b:
        known = fields.get(f.name.lower())
        try:
            kind = f.dataType if known is None else widest(known.dataType, f.dataType)
        except ValueError as error:
            raise ValueError(f"column {f.name}: {error}") from None
        fields[f.name.lower()] = T.StructField(known.name if known else f.name, kind)
    return T.StructType(list(fields.values()))


def footers(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``schema`` (as JSON) of every file below ``path``. Tasks read footers only."""
    open_file = opener()
    key = FOOTER_KEY

    # Defined here so that it travels with the task: workers need not have this package.
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            rows = []
            for name in batch["path"]:
                system, plain = open_file(name)
                with system.open_input_file(plain) as file:
                    schema = pq.read_schema(file)
                # Spark writes its own types into the footer; other writers do not.
                own = (schema.metadata or {}).get(key)
                rows.append((name, own.decode() if own else from_arrow_schema(schema).json()))
            yield pd.DataFrame(rows, columns=["path", "schema"])

    files = list_landing(spark, path, below=True).where("length > 0").select("path")
    tasks = spark.sparkContext.defaultParallelism
    return files.repartition(tasks).mapInPandas(read, "path string, schema string")


def discover(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]]:
    """The columns of all Parquet files below ``path``, and which of them are partitions.

    Different schemas reach the driver, once each, in the order of their first path.
    """
    found = footers(spark, path).groupBy("schema").agg(F.min("path").alias("first")).collect()
    schemas = [T.StructType.fromJson(json.loads(r.schema)) for r in sorted(found, key=lambda r: r.first)]
    written = reduce(merged, schemas, T.StructType([]))
    known = {f.name.lower() for f in written}
    # Spark takes the columns from one file here, and the partitions from all paths.
    partitions = [f for f in spark.read.schema(written).parquet(path).schema if f.name.lower() not in known]
    return T.StructType([*written, *partitions]), [f.name for f in partitions]
