"""Text helpers of the station pipeline."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What replaces what in an attribute name, in this order.
NAME_REPLACEMENTS = ((" ", "-"), (")", ""), ("(", ""), ("°c", "c"))

# Any character that is not white space. (?U) widens \s to all Unicode spaces;
# the four separators 1C-1F count as white space too.
_VISIBLE = r"(?U)[^\s\x1c-\x1f]"


def attribute_name(header: str) -> str:
    """``Max Temp (°C)`` becomes ``max-temp-c``. Works on names, not on rows."""
    name = header.lower()
    for old, new in NAME_REPLACEMENTS:
        name = name.replace(old, new)
    return name


def has_text(value: Column) -> Column:
    """True when ``value`` holds anything but white space; false for null."""
    return F.coalesce(value.rlike(_VISIBLE), F.lit(False))
