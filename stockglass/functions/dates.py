"""Dates with two-digit years."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SHORT_DATE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$"


def short_date(value: Column) -> Column:
    """Month/day/two-digit year as a DATE; 69-99 are 1969-1999. Null when not a date.

    The century is written out before parsing, as Spark takes every two-digit
    year for 2000-2099.
    """
    year = F.right(value, F.lit(2))
    century = F.when(year >= "69", "19").otherwise("20")
    written_out = F.concat(F.substring_index(value, "/", 2), F.lit("/"), century, year)
    return F.try_to_date(F.when(value.rlike(_SHORT_DATE), written_out), "M/d/yyyy")


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
