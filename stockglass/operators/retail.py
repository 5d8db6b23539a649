"""Inventory joined with sales, and its weekly summary.

Several formulas look odd and are meant to be as they are:

* ``low_stock_flg`` is 1 when *less was sold than is on hand*.
* The last reading of a week is the one with the highest day number, and
  Sunday has number 1 (see :func:`stockglass.functions.weeks.closing_rank`).
* On-hand, on-order and out-of-stock values count once per sales row, so they
  multiply with the number of transactions of a day.
* ``percent_in_stock`` is the out-of-stock count over seven.
* ``potential_low_stock_impact`` subtracts units from money.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stockglass.functions.weeks import DAY_OF_WEEK, closing_rank, day_number, week_start
from stockglass.schemas import FACT_KEYS, WEEK_KEYS, WEEKLY_MEASURES

_DAYS = range(1, 8)


def _readings(inventory: DataFrame) -> DataFrame:
    return inventory.withColumnRenamed("cal_dt", "trans_dt")


def daily_fact(
    sales: DataFrame, inventory: DataFrame, *, split_hot_keys: bool = True
) -> DataFrame:
    """Every sales row beside the inventory reading of its product, store and day.

    An inner join: readings without a sale and sales without a reading drop
    out. No hint is given, so Spark broadcasts a small side. Else it sorts and
    merges, streaming the sales past the few readings of a key, and splits a
    hot key at run time (AQE skew join). It can do so only where a shuffle
    feeds the join directly, and an input that is already partitioned by the
    keys, such as an aggregate, would save that shuffle. The hash among the
    join keys asks for it. Leave it out (``split_hot_keys=False``) for tables
    bucketed by the keys that have no hot key.

    Typed keys also match ``0200`` with ``200``; read the files as text to
    keep such keys apart.
    """
    readings, keys = _readings(inventory), list(FACT_KEYS)
    reading_columns = [c for c in readings.columns if c not in FACT_KEYS]
    sales_columns = [c for c in sales.columns if c not in FACT_KEYS]
    if split_hot_keys:
        key_hash = F.xxhash64(*FACT_KEYS)
        readings = readings.withColumn("key_hash", key_hash)
        sales = sales.withColumn("key_hash", key_hash)
        keys.append("key_hash")
    return (
        sales.alias("sale")
        .join(readings.alias("reading"), keys, "inner")
        .select(
            *FACT_KEYS,
            *[F.col(f"reading.`{c}`") for c in reading_columns],
            *[F.col(f"sale.`{c}`") for c in sales_columns],
        )
    )


def low_stock(compare_as_text: bool = False) -> Column:
    """1 when the quantity sold is below the quantity on hand, else 0 (null counts as 0).

    ``compare_as_text`` compares character by character (``'100' < '20'``), as
    happens when both columns are text.
    """
    sold, on_hand = F.col("sales_qty"), F.col("inventory_on_hand_qty")
    if compare_as_text:
        sold, on_hand = sold.cast("string"), on_hand.cast("string")
    return F.when(sold < on_hand, 1).otherwise(0)


def with_low_stock_flag(fact: DataFrame, compare_as_text: bool = False) -> DataFrame:
    return fact.withColumn("low_stock_flg", low_stock(compare_as_text))


def with_calendar(df: DataFrame) -> DataFrame:
    """Adds ``day_of_week`` and ``wk_timestamp``."""
    return df.withColumns(
        {
            "day_of_week": day_number(F.col("trans_dt")),
            "wk_timestamp": week_start(F.col("trans_dt")),
        }
    )


def last_days(sales: DataFrame, inventory: DataFrame, week_end: str = DAY_OF_WEEK) -> DataFrame:
    """The closing rank per week, store and product, over days that have both a reading and a sale.

    The days of a week are the bits of a number: one bit set for the sales, one for
    the readings. Both come from a single aggregate, combined before its shuffle, so a
    hot key costs one row per task, and no join is needed to find the days they share.
    The last day is the top bit.
    """
    bit = F.call_function("shiftleft", F.lit(1), closing_rank(F.col("trans_dt"), week_end))

    def days(rows: DataFrame, sold: Column, read: Column) -> DataFrame:
        week = week_start(F.col("trans_dt")).alias("wk_timestamp")
        bits = rows.select(week, "store_key", "prod_key", sold.alias("sold"), read.alias("read"))
        return bits.dropna(subset=list(WEEK_KEYS))  # rows without a key meet nothing

    none = F.lit(0)
    both = days(sales, bit, none).unionByName(days(_readings(inventory), none, bit))
    shared = F.bit_or("sold").bitwiseAND(F.bit_or("read"))
    return (
        both.groupBy(*WEEK_KEYS)
        .agg(shared.alias("shared"))
        .where("shared > 0")
        .select(*WEEK_KEYS, (F.length(F.bin("shared")) - 1).alias("last_day"))
    )


def flag_last_of_week(
    sales: DataFrame, inventory: DataFrame, week_end: str = DAY_OF_WEEK
) -> DataFrame:
    """The daily fact with calendar columns and ``last_inv_for_week_flag``.

    This is the maximum over the whole (week, store, product) partition. A
    window would bring all fact rows of a group into one task, however hot the
    group is. Here the maximum comes from the day bits, it is attached to the
    inventory readings (one per key and day), and the sales rows only pass the fact
    join.
    """
    readings = (
        with_calendar(_readings(inventory))
        .join(last_days(sales, inventory, week_end), list(WEEK_KEYS), "inner")
        .withColumn(
            "last_inv_for_week_flag", closing_rank(F.col("trans_dt"), week_end) == F.col("last_day")
        )
        .drop("last_day")
    )
    return daily_fact(sales, readings)


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number. Text is read as a double, whatever its size or scale; text
    that is no number becomes null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("double")
    return F.col(name)


def _readings_by_level(inventory: DataFrame) -> DataFrame:
    """Readings of one product, store and day with equal on-hand quantity, folded into one.

    Proper inventory has one reading per key. Should a key repeat, the join
    meets its distinct levels only, not every pair of rows.
    """
    flag = _number(inventory, "out_of_stock_flg").try_cast("int")
    return (
        _readings(inventory)
        .groupBy(*FACT_KEYS, "inventory_on_hand_qty")
        .agg(
            F.count(F.lit(1)).alias("reading_rows"),
            F.sum(_number(inventory, "inventory_on_order_qty")).alias("on_order"),
            F.sum(flag).alias("out_flags"),
            F.count_if(flag == 1).alias("out_rows"),
        )
    )


def weekly_summary(
    sales: DataFrame,
    inventory: DataFrame,
    *,
    compare_as_text: bool = False,
    week_end: str = DAY_OF_WEEK,
) -> DataFrame:
    """Sales, end-of-week stock and stock-out impact per week, store and product.

    Equal to flagging the daily fact and aggregating it. Repeated readings are
    folded first and carry their row count as a weight. The join is that of the
    daily fact, so Spark can split a hot key however many quantities it has, and
    its rows are combined per week before they are shuffled. The last day of the
    week is chosen after that from seven sums, one per day. Hence no window and no
    second pass over the join.
    """
    sold = sales.select(
        *FACT_KEYS,
        "sales_qty",
        _number(sales, "sales_qty").alias("qty"),
        _number(sales, "sales_amt").alias("amount"),
        _number(sales, "sales_cost").alias("cost"),
    )
    readings = _readings_by_level(inventory)
    readings = readings.withColumns(
        {
            "on_hand": _number(readings, "inventory_on_hand_qty"),
            "reading_rows": F.col("reading_rows").cast("int"),
            "out_rows": F.col("out_rows").cast("int"),
        }
    )
    day = F.col("trans_dt")
    met = daily_fact(sold, readings).withColumns(
        {
            # Text columns are summed as numbers, but compared as they are.
            "low": low_stock(compare_as_text),
            "wk_timestamp": week_start(day),
            "rank": closing_rank(day, week_end),
        }
    )
    # Each reading counts once per sales row, each sales row once per reading.
    fact = met.selectExpr(
        *WEEK_KEYS,
        "rank",
        "qty * reading_rows AS qty",
        "amount * reading_rows AS amount",
        "cost * reading_rows AS cost",
        "on_hand * reading_rows AS on_hand",
        "on_order",
        "out_flags",
        "low * reading_rows AS low_flags",
        "CASE WHEN low = 1 THEN amount - on_hand ELSE 0 END * reading_rows AS low_impact",
        # Rows without the flag count 0: an impact is null only if there are none of those.
        "coalesce(amount * out_rows, CASE WHEN out_rows < reading_rows THEN 0 END) AS out_impact",
    )
    sums = ("qty", "amount", "cost", "out_flags", "low_flags", "low_impact", "out_impact")
    grouped = fact.groupBy(*WEEK_KEYS).agg(
        F.expr("min(rank) AS first_rank"),
        F.expr("max(rank) AS last_rank"),
        *[F.expr(f"sum({c}) AS {c}") for c in sums],
        *[
            F.expr(f"sum(CASE WHEN rank = {d} THEN {c} END) AS {c}_{d}")
            for c in ("on_hand", "on_order")
            for d in _DAYS
        ],
    )

    def closing(level: str) -> str:
        """The last day's sum. Other days count as 0, so null only if there is no other day."""
        by_rank = ", ".join(f"{level}_{d}" for d in _DAYS)
        return (
            f"CAST(coalesce(element_at(array({by_rank}), last_rank),"
            " CASE WHEN first_rank < last_rank THEN 0 END) AS DOUBLE)"
        )

    return grouped.selectExpr(
        *WEEK_KEYS,
        "CAST(qty AS DOUBLE) AS total_sales_qty",
        "CAST(amount AS DOUBLE) AS total_sales_amount",
        "CAST(cost AS DOUBLE) AS total_sales_cost",
        f"{closing('on_hand')} AS stock_level_EOW",
        f"{closing('on_order')} AS order_level_EOW",
        "out_flags / 7 AS percent_in_stock",
        "out_flags + low_flags AS total_low_stock_impact",
        "CAST(low_impact AS DOUBLE) AS potential_low_stock_impact",
        "CAST(out_impact AS DOUBLE) AS no_stock_impact",
        "low_flags AS low_stock_instances",
        "out_flags AS no_stock_instances",
        "try_divide(total_sales_amount, total_sales_qty) AS avg_sales_price",
        "try_divide(stock_level_EOW, total_sales_qty) AS weeks_on_hand_stock_can_supply",
    ).select(*WEEK_KEYS, *WEEKLY_MEASURES)


def eow_levels(summary: DataFrame) -> DataFrame:
    """Only the end-of-week levels; Spark drops the other aggregates from the plan."""
    return summary.select(*WEEK_KEYS, "stock_level_EOW", "order_level_EOW")


def stock_impact(summary: DataFrame) -> DataFrame:
    return summary.select(*WEEK_KEYS, "potential_low_stock_impact", "no_stock_impact")
