"""Calendar columns of the weekly summary."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_OF_WEEK = "day_of_week"
DATE = "date"


def week_start(day: Column) -> Column:
    """Monday 00:00 of the week ``day`` lies in, as a timestamp."""
    return F.date_trunc("week", day)


def day_number(day: Column) -> Column:
    """1 for Sunday up to 7 for Saturday."""
    return F.dayofweek(day)


def closing_rank(day: Column, week_end: str = DAY_OF_WEEK) -> Column:
    """1..7; the day with the highest number closes the week.

    ``day_of_week`` numbers Sunday 1, so although weeks start on Monday,
    Saturday outranks the Sunday that follows it. ``date`` ranks Monday 1 and
    Sunday 7, so the latest date closes the week.
    """
    if week_end == DAY_OF_WEEK:
        return F.dayofweek(day)
    if week_end == DATE:
        return F.weekday(day) + F.lit(1)
    raise ValueError(f"week_end must be {DAY_OF_WEEK!r} or {DATE!r}, not {week_end!r}")
