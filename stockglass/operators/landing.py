"""Which of a day's files have landed. Input is a listing: a DataFrame with ``path``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockglass.schemas import REQUIRED_TABLES


def landed_files(
    listing: DataFrame,
    prefix: str = "",
    required: Sequence[str] = REQUIRED_TABLES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``table_name`` and ``file_date`` of the files ``{prefix}/{table}_{date}.csv``, or of
    the parts in a folder of that name; also the listing's columns ``keep``."""
    tables = "|".join(re.escape(t) for t in required)
    folder = f"(?:^|/){re.escape(prefix.strip('/'))}/" if prefix else "(?:^|/)"
    pattern = rf"{folder}({tables})_([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\.csv(?:/[^/_.][^/]*)?$"
    return listing.select(
        F.regexp_extract("path", pattern, 1).alias("table_name"),
        F.regexp_extract("path", pattern, 2).alias("file_date"),
        *keep,
    ).where(F.col("table_name") != "")


def completeness(
    listing: DataFrame, prefix: str = "", required: Sequence[str] = REQUIRED_TABLES
) -> DataFrame:
    """One row per date that has any file: is it complete, which tables are missing."""
    seen = landed_files(listing, prefix, required).groupBy("file_date").agg(
        *[F.bool_or(F.col("table_name") == t).alias(f"has_{t}") for t in required]
    )
    missing = F.array_compact(F.array(*[F.when(~F.col(f"has_{t}"), F.lit(t)) for t in required]))
    return seen.select("file_date", missing.alias("missing")).select(
        "file_date",
        (F.size("missing") == 0).alias("complete"),
        (F.lit(len(required)) - F.size("missing")).alias("present_count"),
        "missing",
    )


def missing_files(
    listing: DataFrame,
    dates: DataFrame | None = None,
    prefix: str = "",
    required: Sequence[str] = REQUIRED_TABLES,
) -> DataFrame:
    """Required files that are not in the listing, for ``dates.file_date`` or every listed date.

    One aggregation of the listing by date; given dates without any file lack all.
    """
    seen = completeness(listing, prefix, required).select("file_date", "missing")
    if dates is not None:
        everything = F.array(*[F.lit(t) for t in required])
        seen = dates.select("file_date").distinct().join(seen, "file_date", "left")
        seen = seen.select("file_date", F.coalesce("missing", everything).alias("missing"))
    return seen.select("file_date", F.explode("missing").alias("table_name"))
