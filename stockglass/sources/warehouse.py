"""Tables to validate: from the catalog, or from a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table read in ``partitions`` ranges of ``split_column``.

    The bounds only place the cuts; rows outside of them are read too.
    """
    return (
        spark.read.format("jdbc")
        .options(
            **{
                "url": url,
                "dbtable": table,
                "partitionColumn": split_column,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(partitions),
                **(options or {}),
            }
        )
        .load()
    )
