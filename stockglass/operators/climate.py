"""Station rows as sparse keyed items, and items as a wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockglass.functions.dates import iso_date, short_date
from stockglass.functions.names import column
from stockglass.functions.text import attribute_name, has_text
from stockglass.schemas import STATION_DATE, STATION_YEAR
from stockglass.sources.csv_set import ARRIVAL

ITEM_KEYS = ("year", "date")
_NOT_ATTRIBUTES = (STATION_YEAR, STATION_DATE, ARRIVAL)


def attribute_columns(columns: Sequence[str]) -> dict[str, list[str]]:
    """Attribute name -> the file columns that carry it, in file order."""
    by_name: dict[str, list[str]] = {}
    for c in columns:
        if c not in _NOT_ATTRIBUTES:
            by_name.setdefault(attribute_name(c), []).append(c)
    return by_name


def _value(sources: Sequence[str]) -> Column:
    """The last non-blank one of the columns, unstripped; null when all are blank."""
    return F.coalesce(*[F.when(has_text(column(c)), column(c)) for c in reversed(sources)])


def attributes(columns: Sequence[str]) -> Column:
    """All non-blank attributes of a row as a map; blank ones are absent."""
    entries: list[Column] = []
    for name, sources in attribute_columns(columns).items():
        if name not in ITEM_KEYS:
            entries += [F.lit(name), _value(sources)]
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())


Years = int | str | Sequence[int | str] | None


def dated_rows(rows: DataFrame, years: Years) -> DataFrame:
    """Rows whose ``Year`` equals, as text, a wanted year (``None``: all rows);
    ``station_day`` is null for a bad date."""
    wanted = rows
    if years is not None:
        texts = [str(y) for y in ([years] if isinstance(years, (int, str)) else years)]
        wanted = rows.where(column(STATION_YEAR).isin(*texts))
    return wanted.withColumn("station_day", short_date(column(STATION_DATE)))


def to_items(dated: DataFrame) -> DataFrame:
    """Items ``(year, date, attributes)`` of the rows with a good date.

    A column whose normalised name is ``year`` or ``date`` replaces that key
    where it is not blank. ``_arrival`` is passed on if the rows carry it.
    """
    named = attribute_columns([c for c in dated.columns if c != "station_day"])

    def key(name: str, otherwise: Column) -> Column:
        return F.coalesce(_value(named[name]), otherwise) if name in named else otherwise

    return dated.where(F.col("station_day").isNotNull()).select(
        key("year", column(STATION_YEAR)).alias("year"),
        key("date", iso_date(F.col("station_day"))).alias("date"),
        attributes([c for c in dated.columns if c != "station_day"]).alias("attributes"),
        *([ARRIVAL] if ARRIVAL in dated.columns else []),
    )


def to_rejects(dated: DataFrame) -> DataFrame:
    """The rows whose date could not be read, as they came."""
    return dated.where(F.col("station_day").isNull()).drop("station_day")


def station_items(rows: DataFrame, years: Years) -> tuple[DataFrame, DataFrame]:
    """(items, rejects) of the wanted years. A bad date costs its row, not the load."""
    dated = dated_rows(rows, years)
    return to_items(dated), to_rejects(dated)


def last_per_key(items: DataFrame) -> DataFrame:
    """One whole item per key: the one that arrived last. Items are never merged.

    The order is file time, file path, then the position Spark read the row at.
    ``max_by`` is combined before the shuffle, so a key that holds a third of
    the rows sends one row per task.
    """
    order = F.col(ARRIVAL) if ARRIVAL in items.columns else F.monotonically_increasing_id()
    return (
        items.withColumn("arrived", order)
        .groupBy(*ITEM_KEYS)
        .agg(F.max_by("attributes", "arrived").alias("attributes"))
    )


def range_query(items: DataFrame, year: int | str, start: str, end: str) -> DataFrame:
    """Items of one year with ``start <= date <= end`` compared as text, ascending by date."""
    return items.where(
        (F.col("year") == F.lit(str(year))) & F.col("date").between(str(start), str(end))
    ).orderBy("date")


def attribute_names(items: DataFrame, *, empty_items: bool = False) -> list[str | None]:
    """All attribute names that occur, sorted. One row per name reaches the driver.

    With ``empty_items`` the last is ``None`` if an item has no attribute, so that
    an empty list means no items.
    """
    explode = F.explode_outer if empty_items else F.explode
    names = items.select(explode(F.map_keys("attributes")).alias("name")).distinct()
    return sorted((row.name for row in names.collect()), key=lambda n: (n is None, n))


def explode_items(items: DataFrame) -> DataFrame:
    return items.select(*ITEM_KEYS, F.explode("attributes").alias("attribute", "value"))


def to_wide(items: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One column per attribute, null where an item lacks it."""
    names = attribute_names(items) if names is None else names
    return items.select(
        *ITEM_KEYS, *[F.col("attributes").getItem(name).alias(name) for name in names]
    )
