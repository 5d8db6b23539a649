"""The registered queries as SQL over the given tables, for comparison in DuckDB."""

from __future__ import annotations

# Tables the jobs read, as common table expressions.
_SALES = """
sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS trans_id,
         CAST(l_shipdate AS DATE) AS trans_dt,
         100 + l_suppkey % 8 AS store_key,
         l_partkey % 10 AS prod_key,
         CAST(l_quantity AS DECIMAL(12,2)) AS sales_qty,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS sales_amt,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.8 AS DECIMAL(18,4)) AS sales_cost,
         CAST(l_discount AS DECIMAL(6,4)) AS discount
  FROM lineitem
)"""

_INVENTORY = (
    _SALES
    + """,
sold_days AS (
  SELECT DISTINCT prod_key, store_key, trans_dt,
         datediff('day', DATE '1995-01-01', trans_dt) AS dd
  FROM sales
),
inventory AS (
  SELECT trans_dt AS cal_dt, store_key, prod_key,
         CAST((store_key * 31 + prod_key * 17 + dd * 7) % 60 AS DECIMAL(12,2))
           AS inventory_on_hand_qty,
         CAST((store_key * 13 + prod_key * 5 + dd * 3) % 40 AS DECIMAL(12,2))
           AS inventory_on_order_qty,
         CAST(CASE WHEN (store_key * 31 + prod_key * 17 + dd * 7) % 60 < 5 THEN 1 ELSE 0 END
              AS INTEGER) AS out_of_stock_flg
  FROM sold_days WHERE (store_key + prod_key + dd) % 11 <> 0
)"""
)

_INVENTORY_RAW = (
    _INVENTORY
    + """,
inventory_days AS (
  SELECT *, datediff('day', DATE '1995-01-01', cal_dt) AS dd FROM inventory
),
inventory_raw AS (
  SELECT cal_dt, store_key - 3 AS store_key,
         CASE WHEN dd % 50 <> 0 THEN prod_key END AS prod_key,
         CASE WHEN dd % 41 = 0 THEN CAST(-1 AS DECIMAL(12,2))
              WHEN dd % 43 <> 0 THEN inventory_on_hand_qty END AS inventory_on_hand_qty,
         inventory_on_order_qty,
         CASE WHEN dd % 37 = 0 THEN 2
              WHEN dd % 53 <> 0 THEN out_of_stock_flg END AS out_of_stock_flg
  FROM inventory_days
)"""
)

_SALES_RAW = """
sales_raw AS (
  SELECT trans_id, store_key - 3 AS store_key,
         CASE WHEN trans_id % 10 <> 7 THEN discount - CAST(0.01 AS DECIMAL(6,4)) END AS discount
  FROM sales
)"""


def _fact(low: str = "sales_qty < inventory_on_hand_qty", rank: str = "dayofweek(trans_dt)") -> str:
    return (
        _INVENTORY
        + f""",
fact AS (
  SELECT i.prod_key, i.store_key, s.trans_dt, i.inventory_on_hand_qty, i.inventory_on_order_qty,
         i.out_of_stock_flg, s.trans_id, s.sales_qty, s.sales_amt, s.sales_cost, s.discount,
         CASE WHEN {low} THEN 1 ELSE 0 END AS low_stock_flg,
         CAST(dayofweek(trans_dt) + 1 AS INTEGER) AS day_of_week,
         CAST(date_trunc('week', trans_dt) AS TIMESTAMP) AS wk_timestamp,
         {rank} AS closing_rank
  FROM inventory i JOIN sales s
    ON i.prod_key = s.prod_key AND i.store_key = s.store_key AND i.cal_dt = s.trans_dt
),
flagged AS (
  SELECT *, closing_rank = max(closing_rank)
              OVER (PARTITION BY wk_timestamp, store_key, prod_key) AS last_inv_for_week_flag
  FROM fact
)"""
    )


def _weekly(**options: str) -> str:
    return (
        _fact(**options)
        + """,
measures AS (
  SELECT wk_timestamp, store_key, prod_key,
         CAST(sum(sales_qty) AS DOUBLE) AS total_sales_qty,
         CAST(sum(sales_amt) AS DOUBLE) AS total_sales_amount,
         CAST(sum(sales_cost) AS DOUBLE) AS total_sales_cost,
         CAST(sum(CASE WHEN last_inv_for_week_flag THEN inventory_on_hand_qty ELSE 0 END)
              AS DOUBLE) AS stock_level_EOW,
         CAST(sum(CASE WHEN last_inv_for_week_flag THEN inventory_on_order_qty ELSE 0 END)
              AS DOUBLE) AS order_level_EOW,
         CAST(sum(out_of_stock_flg) AS DOUBLE) / 7 AS percent_in_stock,
         CAST(sum(out_of_stock_flg) + sum(low_stock_flg) AS BIGINT) AS total_low_stock_impact,
         CAST(sum(CASE WHEN low_stock_flg = 1 THEN sales_amt - inventory_on_hand_qty ELSE 0 END)
              AS DOUBLE) AS potential_low_stock_impact,
         CAST(sum(CASE WHEN out_of_stock_flg = 1 THEN sales_amt ELSE 0 END) AS DOUBLE)
           AS no_stock_impact,
         CAST(sum(low_stock_flg) AS BIGINT) AS low_stock_instances,
         CAST(sum(out_of_stock_flg) AS BIGINT) AS no_stock_instances
  FROM flagged GROUP BY wk_timestamp, store_key, prod_key
),
summary AS (
  SELECT wk_timestamp, store_key, prod_key, total_sales_qty, total_sales_amount,
         CASE WHEN total_sales_qty <> 0 THEN total_sales_amount / total_sales_qty END
           AS avg_sales_price,
         total_sales_cost, stock_level_EOW, order_level_EOW, percent_in_stock,
         total_low_stock_impact, potential_low_stock_impact, no_stock_impact,
         low_stock_instances, no_stock_instances,
         CASE WHEN total_sales_qty <> 0 THEN stock_level_EOW / total_sales_qty END
           AS weeks_on_hand_stock_can_supply
  FROM measures
)"""
    )


def _judged(kind: str, column: str, table: str, bad: str) -> str:
    """One result row of an expectation; ``bad`` selects its failing rows."""
    missing = "0" if kind == "not_be_null" else f"count(*) FILTER (WHERE {column} IS NULL)"
    return f"""
  SELECT 'expect_column_values_to_{kind}' AS expectation_type, '{column}' AS "column",
         count(*) AS element_count, CAST({missing} AS BIGINT) AS missing_count,
         count(*) FILTER (WHERE {bad}) AS unexpected_count
  FROM {table}"""


def _results(rows: str, with_position: str = "") -> str:
    return f"""
  SELECT {with_position} expectation_type, "column", unexpected_count = 0 AS success,
         element_count, missing_count, unexpected_count,
         CASE WHEN element_count > missing_count
              THEN CAST(unexpected_count AS DOUBLE) * 100.0 / (element_count - missing_count)
         END AS unexpected_percent
  FROM ({rows})"""


def _repeated(table: str) -> str:
    return (
        f"trans_id IN (SELECT trans_id FROM {table} GROUP BY trans_id HAVING count(*) > 1)"
    )


def _inventory_rules(table: str) -> list[str]:
    return [
        _judged("not_be_null", "prod_key", table, "prod_key IS NULL"),
        _judged("be_in_set", "out_of_stock_flg", table, "out_of_stock_flg NOT IN (0, 1)"),
        _judged("be_between", "store_key", table, "store_key NOT BETWEEN 100 AND 9999"),
        _judged(
            "be_between",
            "inventory_on_hand_qty",
            table,
            "inventory_on_hand_qty NOT BETWEEN 0 AND 999999",
        ),
    ]


def _sales_rules(table: str) -> list[str]:
    return [
        _judged("be_unique", "trans_id", table, _repeated(table)),
        _judged("be_between", "store_key", table, "store_key NOT BETWEEN 100 AND 9990"),
        _judged("be_between", "discount", table, "discount NOT BETWEEN 0 AND 1"),
    ]


def _suite(name: str, rules: list[str]) -> str:
    numbered = "\n  UNION ALL ".join(
        f"SELECT {i} AS position, * FROM ({rule})" for i, rule in enumerate(rules)
    )
    return _results(numbered, f"'{name}' AS suite, position,")


_INVENTORY_RESULTS = _suite("input_data_snowflake_check", _inventory_rules("inventory_raw"))
_SALES_RESULTS = _suite("sales_data_check", _sales_rules("sales_raw"))

_CLIMATE = """
station_days AS (
  SELECT CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS top, count(*) AS n
  FROM orders GROUP BY 1
),
climate AS (
  SELECT CAST(year(day) AS VARCHAR) AS station_year, day,
         strftime(day, '%m/%d/%y') AS date_text, strftime(day, '%Y-%m-%d') AS iso_date,
         CAST(CAST(top AS DECIMAL(12,2)) AS VARCHAR) AS max_temp,
         CASE WHEN n % 3 = 0 THEN ' ' ELSE CAST(n AS VARCHAR) END AS quality
  FROM station_days
),
items AS (
  SELECT station_year AS "year", iso_date AS "date",
         CASE WHEN trim(quality) <> '' THEN quality END AS "data-quality",
         CASE WHEN trim(max_temp) <> '' THEN max_temp END AS "max-temp-c"
  FROM climate
)"""

_ITEM_COLUMNS = '"year", "date", "data-quality", "max-temp-c"'
_IN_RANGE = """ WHERE "year" = '1996' AND "date" BETWEEN '1996-02-15' AND '1996-10-20'"""

_LISTING = """
ship_days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem),
wanted AS (
  SELECT strftime(day, '%Y-%m-%d') AS file_date, table_name, position,
         datediff('day', DATE '1995-01-01', day) AS dd
  FROM ship_days CROSS JOIN (
    VALUES ('calendar', 0), ('inventory', 1), ('sales', 2), ('store', 3), ('product', 4)
  ) AS t(table_name, position)
),
listed AS (SELECT * FROM wanted WHERE (dd + position) % 13 <> 0)"""

# Order in which missing tables are named.
_ORDER = """list_position(['calendar', 'inventory', 'sales', 'store', 'product'], w.table_name)"""

_WEEK_COLUMNS = "wk_timestamp, store_key, prod_key"


def _raw(rules_table: str) -> str:
    return "WITH" + (_INVENTORY_RAW if rules_table == "inventory_raw" else _SALES + "," + _SALES_RAW)


ORACLE_SQL: dict[str, str] = {
    "weekly_inventory_summary": f"WITH{_weekly()} SELECT * FROM summary",
    "weekly_summary_by_date": f"WITH{_weekly(rank='isodow(trans_dt)')} SELECT * FROM summary",
    "weekly_summary_text_compare": "WITH"
    + _weekly(low="CAST(sales_qty AS VARCHAR) < CAST(inventory_on_hand_qty AS VARCHAR)")
    + " SELECT * FROM summary",
    "daily_fact": f"""WITH{_fact()}
        SELECT prod_key, store_key, trans_dt, inventory_on_hand_qty, inventory_on_order_qty,
               out_of_stock_flg, trans_id, sales_qty, sales_amt, sales_cost, discount
        FROM fact""",
    "low_stock_flag": f"""WITH{_fact()}
        SELECT trans_id, prod_key, store_key, trans_dt, sales_qty, inventory_on_hand_qty,
               low_stock_flg
        FROM fact""",
    "week_calendar": f"""WITH{_SALES}
        SELECT DISTINCT trans_dt, CAST(dayofweek(trans_dt) + 1 AS INTEGER) AS day_of_week,
               CAST(date_trunc('week', trans_dt) AS TIMESTAMP) AS wk_timestamp
        FROM sales""",
    "last_inventory_of_week": f"""WITH{_fact()}
        SELECT trans_id, prod_key, store_key, trans_dt, day_of_week, wk_timestamp,
               last_inv_for_week_flag
        FROM flagged""",
    "weekly_eow_levels": f"""WITH{_weekly()}
        SELECT {_WEEK_COLUMNS}, stock_level_EOW, order_level_EOW FROM summary""",
    "weekly_stock_impact": f"""WITH{_weekly()}
        SELECT {_WEEK_COLUMNS}, potential_low_stock_impact, no_stock_impact FROM summary""",
    "dq_not_null": _raw("inventory_raw") + _results(_inventory_rules("inventory_raw")[0]),
    "dq_in_set": _raw("inventory_raw") + _results(_inventory_rules("inventory_raw")[1]),
    "dq_between": _raw("inventory_raw") + _results(_inventory_rules("inventory_raw")[3]),
    "dq_unique": _raw("sales_raw") + _results(_sales_rules("sales_raw")[0]),
    "dq_suite_inventory": _raw("inventory_raw") + _INVENTORY_RESULTS,
    "dq_suite_table": _raw("inventory_raw") + _INVENTORY_RESULTS,
    "dq_suite_sales": _raw("sales_raw") + _SALES_RESULTS,
    "dq_suite_summary": f"""WITH{_INVENTORY_RAW},{_SALES_RAW},
        results AS ({_INVENTORY_RESULTS} UNION ALL {_SALES_RESULTS}),
        stats AS (
          SELECT suite, count(*) AS evaluated_expectations,
                 count(*) FILTER (WHERE success) AS successful_expectations,
                 count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
                 bool_and(success) AS success
          FROM results GROUP BY suite
        )
        SELECT suite, evaluated_expectations, successful_expectations, unsuccessful_expectations,
               CAST(successful_expectations AS DOUBLE) * 100.0 / evaluated_expectations
                 AS success_percent,
               success,
               '{{"suite":"' || suite || '","success":' || CAST(success AS VARCHAR)
               || ',"evaluated_expectations":' || evaluated_expectations
               || ',"successful_expectations":' || successful_expectations
               || ',"unsuccessful_expectations":' || unsuccessful_expectations || '}}' AS record
        FROM stats""",
    "dq_suite_query": f"""WITH{_INVENTORY_RAW},
        lowest AS (
          SELECT prod_key, store_key, min(inventory_on_hand_qty) AS inventory_on_hand_qty,
                 max(out_of_stock_flg) AS out_of_stock_flg
          FROM inventory_raw GROUP BY prod_key, store_key
        )
        {_suite("input_data_snowflake_check", _inventory_rules("lowest"))}""",
    "dq_suite_sample": f"""WITH{_INVENTORY_RAW},
        sampled AS (
          SELECT * FROM inventory_raw
          ORDER BY md5(coalesce(CAST(prod_key AS VARCHAR), '') || '|' || CAST(store_key AS VARCHAR)
                       || '|' || strftime(cal_dt, '%Y-%m-%d') || '|'
                       || coalesce(CAST(inventory_on_hand_qty AS VARCHAR), '') || '|'
                       || coalesce(CAST(out_of_stock_flg AS VARCHAR), ''))
          LIMIT 1000
        )
        {_suite("input_data_snowflake_check", _inventory_rules("sampled"))}""",
    "climate_attribute_names": f"""WITH{_CLIMATE},
        named AS (
          SELECT 'Max Temp (°C)' AS column_name,
                 count(*) FILTER (WHERE trim(max_temp) <> '') AS rows_with_value FROM climate
          UNION ALL
          SELECT 'Data Quality', count(*) FILTER (WHERE trim(quality) <> '') FROM climate
        )
        SELECT column_name,
               replace(replace(replace(replace(lower(column_name), ' ', '-'), ')', ''), '(', ''),
                       '°c', 'c') AS attribute,
               rows_with_value
        FROM named""",
    "climate_date_parse": f"""WITH{_CLIMATE}
        SELECT station_year, date_text, CAST(strptime(date_text, '%m/%d/%y') AS DATE) AS day,
               strftime(strptime(date_text, '%m/%d/%y'), '%Y-%m-%d') AS iso_date
        FROM climate""",
    "climate_sparse_attributes": f"""WITH{_CLIMATE}
        SELECT "year", "date", 'max-temp-c' AS attribute, "max-temp-c" AS "value" FROM items
        WHERE "max-temp-c" IS NOT NULL
        UNION ALL
        SELECT "year", "date", 'data-quality', "data-quality" FROM items
        WHERE "data-quality" IS NOT NULL""",
    "climate_year_load": f"""WITH{_CLIMATE}
        SELECT {_ITEM_COLUMNS} FROM items WHERE "year" = '1996'""",
    "climate_range_query": f"""WITH{_CLIMATE}
        SELECT {_ITEM_COLUMNS} FROM items {_IN_RANGE} ORDER BY "date" """,
    "climate_upsert_latest": f"""WITH{_CLIMATE},
        item_log AS (
          SELECT 0 AS batch_id, {_ITEM_COLUMNS} FROM items
          UNION ALL
          SELECT 1, "year", "date", NULL, 'new ' || "max-temp-c" FROM items
          WHERE CAST("year" AS INTEGER) % 2 = 0 AND "year" <> '1998'
        ),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY "year", "date" ORDER BY batch_id DESC) AS rn
          FROM item_log
        )
        SELECT {_ITEM_COLUMNS} FROM ranked WHERE rn = 1""",
    "climate_export_csv": f"""WITH{_CLIMATE}
        SELECT {_ITEM_COLUMNS} FROM items {_IN_RANGE}""",
    "climate_stream_load": f"""WITH{_CLIMATE}
        SELECT "year", "date", CASE WHEN "year" <> '1997' THEN "data-quality" END AS "data-quality",
               "max-temp-c"
        FROM items""",
    "union_csv_by_name": f"""WITH{_CLIMATE}
        SELECT station_year AS "Year", date_text AS "Date/Time", max_temp AS "Max Temp (°C)",
               CASE WHEN station_year <> '1997' THEN quality END AS "Data Quality"
        FROM climate""",
    "union_csv_with_index": f"""WITH{_CLIMATE},
        placed AS (
          SELECT CASE WHEN CAST(station_year AS INTEGER) % 2 = 1 THEN 'a odd' ELSE 'b [even]' END
                   AS kind, date_text, day
          FROM climate
        )
        SELECT row_number() OVER (ORDER BY kind, day) - 1 AS row_index, kind, date_text FROM placed""",
    "scan_landing_csv": f"""WITH{_INVENTORY}
        SELECT cal_dt, store_key, prod_key, inventory_on_hand_qty, inventory_on_order_qty,
               out_of_stock_flg
        FROM inventory""",
    "landing_completeness": f"""WITH{_LISTING}
        SELECT w.file_date, count(*) = 5 AND count(l.table_name) = 5 AS complete,
               CAST(count(l.table_name) AS INTEGER) AS present_count,
               coalesce(string_agg(CASE WHEN l.table_name IS NULL THEN w.table_name END, ','
                                   ORDER BY {_ORDER}), '') AS missing
        FROM wanted w LEFT JOIN listed l
          ON w.file_date = l.file_date AND w.table_name = l.table_name
        GROUP BY w.file_date HAVING count(l.table_name) > 0""",
    "landing_missing": f"""WITH{_LISTING},
        days AS (SELECT DISTINCT file_date FROM listed)
        SELECT w.file_date, w.table_name
        FROM wanted w JOIN days d ON w.file_date = d.file_date
        LEFT JOIN listed l ON w.file_date = l.file_date AND w.table_name = l.table_name
        WHERE l.table_name IS NULL""",
    "landing_file_sizes": f"""WITH{_INVENTORY},
        lines AS (
          SELECT 'inventory' AS table_name, concat_ws(',', cal_dt, store_key, prod_key,
                   CAST(inventory_on_hand_qty AS DECIMAL(12,2)),
                   CAST(inventory_on_order_qty AS DECIMAL(12,2)), out_of_stock_flg) AS line
          FROM inventory
          UNION ALL
          SELECT 'sales', concat_ws(',', trans_id, trans_dt, store_key, prod_key, sales_qty,
                   sales_amt, sales_cost, discount) FROM sales
        )
        SELECT table_name, count(*) > 0 AS landed,
               CAST(sum(strlen(line) + 1) AS BIGINT) AS row_bytes
        FROM lines GROUP BY table_name""",
    "landing_gate": """WITH dims AS (
          SELECT (SELECT count(*) FROM part) + (SELECT count(*) FROM region)
                 + (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem) AS n)
        SELECT '2002-01-01' AS file_date, '' AS missing, CAST(n AS BIGINT) AS published_rows FROM dims
        UNION ALL SELECT '2002-01-02', 'sales', 0""",
    "publish_archive": f"""WITH{_weekly()}
        SELECT summary.*, days.weekly_summary FROM summary
        CROSS JOIN (VALUES (DATE '2002-01-01'), (DATE '2002-01-02')) AS days(weekly_summary)""",
    "publish_current": f"WITH{_weekly()} SELECT * FROM summary",
    "catalog_registered_summary": f"""WITH{_weekly()}
        SELECT store_key, DATE '2002-01-01' AS weekly_summary, count(*) AS weeks_and_products,
               CAST(sum(low_stock_instances) AS BIGINT) AS low_stock_instances,
               max(stock_level_EOW) AS highest_stock_level
        FROM summary GROUP BY store_key""",
    "catalog_widened_days": f"""WITH{_weekly()}
        SELECT weekly_summary, count(*) AS weeks,
               CAST(sum(low_stock_instances) AS BIGINT) AS low_stock_instances,
               sum(total_sales_qty) AS total_sales_qty,
               CASE WHEN weekly_summary = DATE '2002-01-01' THEN 0 ELSE count(order_level_EOW) END
                 AS order_levels,
               CASE WHEN weekly_summary = DATE '2002-01-03' THEN 0 ELSE count(avg_sales_price) END
                 AS prices
        FROM summary CROSS JOIN (
          VALUES (DATE '2002-01-01'), (DATE '2002-01-02'), (DATE '2002-01-03')) AS days(weekly_summary)
        GROUP BY weekly_summary""",
    "publish_dimensions": r"""WITH dims AS (
          SELECT 'product' AS table_name, CAST(p_partkey AS VARCHAR) AS value_1,
                 p_name AS value_2, p_brand AS value_3
          FROM part
          UNION ALL
          SELECT 'store', CAST(r_regionkey AS VARCHAR),
                 CASE r_regionkey % 5 WHEN 0 THEN r_name || ' "hi", ok'
                   WHEN 1 THEN r_name || chr(10) || 'line'
                   WHEN 2 THEN ' ' || r_name || chr(92) || ' '
                   WHEN 3 THEN '' END, NULL
          FROM region
          UNION ALL SELECT DISTINCT 'calendar', strftime(l_shipdate, '%Y-%m-%d'), NULL, NULL FROM lineitem
        )
        SELECT table_name, copies.copy AS "copy", value_1, value_2, value_3, true AS same_bytes FROM dims
        CROSS JOIN (VALUES ('archive'), ('current')) AS copies(copy)""",
}
