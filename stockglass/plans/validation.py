"""Validation of the raw tables. Never stops a job: the verdict is data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockglass.operators.quality import INVENTORY_SUITE, SALES_SUITE, run_suite, suite_summary
from stockglass.sources.warehouse import read_table


def validate_raw(
    spark: SparkSession, inventory: str = "raw.inventory", sales: str = "raw.sales"
) -> tuple[DataFrame, DataFrame]:
    """(results per expectation, statistics per suite) of both raw tables."""
    results = run_suite(read_table(spark, inventory), INVENTORY_SUITE).unionByName(
        run_suite(read_table(spark, sales), SALES_SUITE)
    )
    return results, suite_summary(results)
