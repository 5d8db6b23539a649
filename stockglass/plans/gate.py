"""The landing gate: publish dimensions once a day is complete."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from stockglass.operators.landing import missing_files
from stockglass.sinks.publish import publish_dimensions
from stockglass.sources.landing import list_landing


def day_before(today: dt.date | None = None) -> str:
    return ((today or dt.date.today()) - dt.timedelta(days=1)).isoformat()


def run_gate(
    spark: SparkSession, landing: str, archive: str, result: str, date: str | None = None
) -> list[str]:
    """Publishes the dimensions of ``date`` (yesterday, if not given) when all extracts are there.

    Returns the names of the missing tables; empty means complete and published.
    """
    date = date or day_before()
    day = spark.createDataFrame([(date,)], "file_date string")
    listing = list_landing(spark, f"{landing.rstrip('/')}/*_{date}.csv")
    missing = sorted(row.table_name for row in missing_files(listing, day).collect())
    if not missing:
        publish_dimensions(spark, landing, date, archive, result)
    return missing
