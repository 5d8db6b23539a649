"""The jobs' input tables, derived by Spark from the given test tables.

The given tables hold no inventory or station data, so each table below is a
formula over a whole given table and grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockglass.schemas import DIMENSION_TABLES, REQUIRED_TABLES

FIRST_DAY = "DATE'1995-01-01'"
LISTED_TABLES = ("calendar", "inventory", "sales", "store", "product")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount = "CAST(l_extendedprice AS DECIMAL(12,2))", "CAST(l_discount AS DECIMAL(4,2))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS trans_id",
        "CAST(l_shipdate AS DATE) AS trans_dt",
        "100 + l_suppkey % 8 AS store_key",
        "l_partkey % 10 AS prod_key",
        "CAST(l_quantity AS DECIMAL(12,2)) AS sales_qty",
        f"CAST({price} * (1 - {discount}) AS DECIMAL(18,4)) AS sales_amt",
        f"CAST({price} * 0.8 AS DECIMAL(18,4)) AS sales_cost",
        "CAST(l_discount AS DECIMAL(6,4)) AS discount",
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per product, store and day with a sale; every eleventh is missing."""
    on_hand = "(store_key * 31 + prod_key * 17 + dd * 7) % 60"
    return (
        sales(spark, sf_dir)
        .select("prod_key", "store_key", "trans_dt")
        .distinct()
        .selectExpr("*", f"datediff(trans_dt, {FIRST_DAY}) AS dd")
        .where("(store_key + prod_key + dd) % 11 <> 0")
        .selectExpr(
            "trans_dt AS cal_dt",
            "store_key",
            "prod_key",
            f"CAST({on_hand} AS DECIMAL(12,2)) AS inventory_on_hand_qty",
            """CAST((store_key * 13 + prod_key * 5 + dd * 3) % 40 AS DECIMAL(12,2))
                 AS inventory_on_order_qty""",
            f"CASE WHEN {on_hand} < 5 THEN 1 ELSE 0 END AS out_of_stock_flg",
        )
    )


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory with violations of every expectation."""
    return (
        inventory(spark, sf_dir)
        .selectExpr("*", f"datediff(cal_dt, {FIRST_DAY}) AS dd")
        .selectExpr(
            "cal_dt",
            "store_key - 3 AS store_key",
            "CASE WHEN dd % 50 <> 0 THEN prod_key END AS prod_key",
            """CASE WHEN dd % 41 = 0 THEN CAST(-1 AS DECIMAL(12,2))
                    WHEN dd % 43 <> 0 THEN inventory_on_hand_qty END AS inventory_on_hand_qty""",
            "inventory_on_order_qty",
            """CASE WHEN dd % 37 = 0 THEN 2
                    WHEN dd % 53 <> 0 THEN out_of_stock_flg END AS out_of_stock_flg""",
        )
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with violations; the last digit of ``trans_id`` is the line number."""
    return sales(spark, sf_dir).withColumns(
        {
            "store_key": F.expr("store_key - 3"),
            "discount": F.expr(
                "CASE WHEN trans_id % 10 <> 7 THEN discount - CAST(0.01 AS DECIMAL(6,4)) END"
            ),
        }
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station row per order date, years 1995-2001.

    The day is taken from an aggregate, not from the grouping key, so that
    checks of the date run on station rows and are not pushed to the orders.
    """
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("CAST(o_orderdate AS DATE)"))
        .agg(
            F.expr("CAST(max(o_orderdate) AS DATE) AS day"),
            F.expr("max(o_totalprice) AS top"),
            F.expr("count(*) AS n"),
        )
        .selectExpr(
            "CAST(year(day) AS STRING) AS Year",
            "date_format(day, 'MM/dd/yy') AS `Date/Time`",
            "CAST(CAST(top AS DECIMAL(12,2)) AS STRING) AS `Max Temp (°C)`",
            "CASE WHEN n % 3 = 0 THEN ' ' ELSE CAST(n AS STRING) END AS `Data Quality`",
        )
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the five extracts per ship date; some are missing."""
    names = ", ".join(f"'{t}'" for t in LISTED_TABLES)
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr("CAST(l_shipdate AS DATE) AS day")
        .distinct()
        .selectExpr("day", f"posexplode(array({names})) AS (position, table_name)")
        .where(f"(datediff(day, {FIRST_DAY}) + position) % 13 <> 0")
        .selectExpr("concat('in/', table_name, '_', CAST(day AS STRING), '.csv') AS path")
    )


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Product, store and calendar as they would land, all text."""
    if name == "product":
        rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    elif name == "store":
        rows = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    elif name == "calendar":
        rows = table(spark, sf_dir, "lineitem").select(
            F.col("l_shipdate").cast("date").alias("cal_dt")
        ).distinct()
    else:
        raise ValueError(name)
    return rows.select(*[F.col(c).cast("string") for c in rows.columns])


def awkward(rows: DataFrame, name: str) -> DataFrame:
    """Store names with what a CSV copy may lose; other tables as they are."""
    if name != "store":
        return rows
    return rows.withColumn(
        "r_name",
        F.expr(
            r"""CASE CAST(r_regionkey AS INT) % 5
                  WHEN 0 THEN concat(r_name, ' "hi", ok')
                  WHEN 1 THEN concat(r_name, chr(10), 'line')
                  WHEN 2 THEN concat(' ', r_name, chr(92), ' ')
                  WHEN 3 THEN '' END"""
        ),
    )


assert set(DIMENSION_TABLES) < set(REQUIRED_TABLES) == set(LISTED_TABLES)
