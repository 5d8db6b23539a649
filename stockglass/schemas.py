"""Column names and types of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

INVENTORY = T.StructType(
    [
        T.StructField("cal_dt", T.DateType()),
        T.StructField("store_key", T.LongType()),
        T.StructField("prod_key", T.LongType()),
        T.StructField("inventory_on_hand_qty", T.DecimalType(12, 2)),
        T.StructField("inventory_on_order_qty", T.DecimalType(12, 2)),
        T.StructField("out_of_stock_flg", T.IntegerType()),
    ]
)

SALES = T.StructType(
    [
        T.StructField("trans_id", T.LongType()),
        T.StructField("trans_dt", T.DateType()),
        T.StructField("store_key", T.LongType()),
        T.StructField("prod_key", T.LongType()),
        T.StructField("sales_qty", T.DecimalType(12, 2)),
        T.StructField("sales_amt", T.DecimalType(18, 4)),
        T.StructField("sales_cost", T.DecimalType(18, 4)),
        T.StructField("discount", T.DecimalType(6, 4)),
    ]
)

# The day's extracts: all five must have landed, three of them are published as they are.
REQUIRED_TABLES = ("calendar", "inventory", "sales", "store", "product")
DIMENSION_TABLES = ("calendar", "store", "product")

FACT_KEYS = ("prod_key", "store_key", "trans_dt")
WEEK_KEYS = ("wk_timestamp", "store_key", "prod_key")

WEEKLY_MEASURES = (
    "total_sales_qty",
    "total_sales_amount",
    "avg_sales_price",
    "total_sales_cost",
    "stock_level_EOW",
    "order_level_EOW",
    "percent_in_stock",
    "total_low_stock_impact",
    "potential_low_stock_impact",
    "no_stock_impact",
    "low_stock_instances",
    "no_stock_instances",
    "weeks_on_hand_stock_can_supply",
)

# Columns of the station files that form the item key.
STATION_YEAR = "Year"
STATION_DATE = "Date/Time"


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns with every value left as the text of the file."""
    return T.StructType([T.StructField(f.name, T.StringType(), f.nullable) for f in schema])
