"""Registered queries: every operator and job over the stand-in tables.

Each callable takes (session, folder of the given tables) and returns a
DataFrame. Queries about sources and sinks write to a new shared scratch folder
and read back what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockglass.functions.dates import iso_date, short_date
from stockglass.functions.names import column
from stockglass.functions.text import has_text
from stockglass.functions.weeks import DATE
from stockglass.operators import climate as cl, combine, landing, quality as dq, retail
from stockglass.plans import standins as st
from stockglass.plans.gate import run_gate
from stockglass.plans.stations import combine_stations, extract_range, load_stations
from stockglass.plans.weekly import run_weekly
from stockglass.schemas import INVENTORY, SALES, STATION_DATE, STATION_YEAR
from stockglass.session import scratch_dir
from stockglass.sinks import publish
from stockglass.sources.csv_set import read_csv_set
from stockglass.sources.items import ensure_items_table, latest_items, read_items, sync_items_table
from stockglass.sources.landing import NULL_TEXT, landing_path, list_landing, read_landing
from stockglass.sources.warehouse import read_table

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2002-01-01"
RANGE = (1996, "1996-02-15", "1996-10-20")


# Retail


def weekly_inventory_summary(spark: SparkSession, sf: str) -> DataFrame:
    return retail.weekly_summary(st.sales(spark, sf), st.inventory(spark, sf))


def weekly_summary_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return retail.weekly_summary(st.sales(spark, sf), st.inventory(spark, sf), week_end=DATE)


def weekly_summary_text_compare(spark: SparkSession, sf: str) -> DataFrame:
    return retail.weekly_summary(
        st.sales(spark, sf), st.inventory(spark, sf), compare_as_text=True
    )


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return retail.daily_fact(st.sales(spark, sf), st.inventory(spark, sf))


def low_stock_flag(spark: SparkSession, sf: str) -> DataFrame:
    return retail.with_low_stock_flag(_fact(spark, sf)).select(
        "trans_id",
        "prod_key",
        "store_key",
        "trans_dt",
        "sales_qty",
        "inventory_on_hand_qty",
        "low_stock_flg",
    )


def week_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return retail.with_calendar(st.sales(spark, sf).select("trans_dt").distinct())


def last_inventory_of_week(spark: SparkSession, sf: str) -> DataFrame:
    return retail.flag_last_of_week(st.sales(spark, sf), st.inventory(spark, sf)).select(
        "trans_id",
        "prod_key",
        "store_key",
        "trans_dt",
        "day_of_week",
        "wk_timestamp",
        "last_inv_for_week_flag",
    )


def weekly_eow_levels(spark: SparkSession, sf: str) -> DataFrame:
    return retail.eow_levels(weekly_inventory_summary(spark, sf))


def weekly_stock_impact(spark: SparkSession, sf: str) -> DataFrame:
    return retail.stock_impact(weekly_inventory_summary(spark, sf))


# Quality


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return dq.run_expectation(st.inventory_raw(spark, sf), dq.not_null("prod_key"))


def dq_in_set(spark: SparkSession, sf: str) -> DataFrame:
    return dq.run_expectation(st.inventory_raw(spark, sf), dq.in_set("out_of_stock_flg", (0, 1)))


def dq_between(spark: SparkSession, sf: str) -> DataFrame:
    return dq.run_expectation(
        st.inventory_raw(spark, sf), dq.between("inventory_on_hand_qty", 0, 999999)
    )


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return dq.run_expectation(st.sales_raw(spark, sf), dq.unique("trans_id"))


def dq_suite_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return dq.run_suite(st.inventory_raw(spark, sf), dq.INVENTORY_SUITE)


def dq_suite_sales(spark: SparkSession, sf: str) -> DataFrame:
    return dq.run_suite(st.sales_raw(spark, sf), dq.SALES_SUITE)


def dq_suite_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dq.suite_summary(
        dq_suite_inventory(spark, sf).unionByName(dq_suite_sales(spark, sf))
    )


def dq_suite_query(spark: SparkSession, sf: str) -> DataFrame:
    """The suite over the result of a query: each product's lowest reading per store."""
    rows = spark.sql(
        """
        SELECT prod_key, store_key,
               min(inventory_on_hand_qty) AS inventory_on_hand_qty,
               max(out_of_stock_flg) AS out_of_stock_flg
        FROM {readings}
        GROUP BY prod_key, store_key
        """,
        readings=st.inventory_raw(spark, sf),
    )
    return dq.run_suite(rows, dq.INVENTORY_SUITE)


def dq_suite_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The suite over a sample of 1,000 rows, picked by a hash of the key."""
    readings = st.inventory_raw(spark, sf)
    key = F.md5(
        F.concat_ws(
            "|",
            F.coalesce(F.col("prod_key").cast("string"), F.lit("")),
            F.col("store_key").cast("string"),
            F.col("cal_dt").cast("string"),
            F.coalesce(F.col("inventory_on_hand_qty").cast("string"), F.lit("")),
            F.coalesce(F.col("out_of_stock_flg").cast("string"), F.lit("")),
        )
    )
    return dq.run_suite(dq.sample_rows(readings, 1000, order_by=key), dq.INVENTORY_SUITE)


# Stations


def climate_attribute_names(spark: SparkSession, sf: str) -> DataFrame:
    """File column, attribute name, and how many rows carry the attribute."""
    rows = st.climate(spark, sf)
    pairs = [(c, name) for name, cs in cl.attribute_columns(rows.columns).items() for c in cs]
    counts = rows.agg(*[F.count_if(has_text(column(c))).alias(name) for c, name in pairs])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.lit(name).alias("attribute"),
                        F.col(f"`{name}`").alias("rows_with_value"),
                    )
                    for c, name in pairs
                ]
            )
        )
    )


def climate_date_parse(spark: SparkSession, sf: str) -> DataFrame:
    text = column(STATION_DATE)
    return st.climate(spark, sf).select(
        column(STATION_YEAR).alias("station_year"),
        text.alias("date_text"),
        short_date(text).alias("day"),
        iso_date(short_date(text)).alias("iso_date"),
    )


def climate_sparse_attributes(spark: SparkSession, sf: str) -> DataFrame:
    items, _ = cl.station_items(st.climate(spark, sf), None)
    return cl.explode_items(items)


def climate_year_load(spark: SparkSession, sf: str) -> DataFrame:
    """One year loaded as a batch and read back."""
    path = scratch_dir(spark, "items")
    load_stations(st.climate(spark, sf), 1996, path, 0)
    return cl.to_wide(read_items(spark, path))


def _all_items(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "items")
    load_stations(st.climate(spark, sf), None, path, 0)
    return path


def climate_range_query(spark: SparkSession, sf: str) -> DataFrame:
    return cl.to_wide(cl.range_query(read_items(spark, _all_items(spark, sf)), *RANGE))


def _unregistered(result: DataFrame, name: str) -> DataFrame:
    """The result, computed, after which the table it came from leaves the catalog."""
    spark, path = result.sparkSession, scratch_dir(result.sparkSession, "result")
    result.write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(result.schema).parquet(path)


def climate_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """All years as the first batch; new values of even years, without a quality, as the
    second, which is written twice: first of all even years, then without 1998."""
    path = scratch_dir(spark, "items")
    name = "items_" + path.rsplit("-", 1)[1]
    ensure_items_table(spark, name, path)
    rows = st.climate(spark, sf)
    load_stations(rows, None, path, 0)
    year = column(STATION_YEAR).cast("int")
    renewed = (
        rows.where(year % 2 == 0)
        .withColumn("Max Temp (°C)", F.concat(F.lit("new "), column("Max Temp (°C)")))
        .drop("Data Quality")
    )
    load_stations(renewed, None, path, 1)
    load_stations(renewed.where(year != 1998), None, path, 1)
    sync_items_table(spark, name)
    return _unregistered(cl.to_wide(latest_items(spark.table(name)), ["data-quality", "max-temp-c"]), name)


def climate_export_csv(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark, "extract")
    extract_range(spark, _all_items(spark, sf), *RANGE, target)
    return spark.read.option("header", True).option("escape", '"').csv(target)


def _write_csv(df: DataFrame, path: str, line_end: str = "\n") -> None:
    (
        df.write.option("header", True)
        .option("lineSep", line_end)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )


def climate_stream_load(spark: SparkSession, sf: str) -> DataFrame:
    """All station rows as arriving files of differing headers, streamed into the item log
    some files at a time. One layout lacks a key column; years beside the wanted ones come too."""
    from stockglass.streaming.stations import start_station_load

    path = scratch_dir(spark, "items")
    files = _write_station_set(spark, sf)
    source = files.removesuffix("/*/*.csv")
    rows = spark.read.parquet(f"{source}-rows")
    _write_csv(rows.drop(STATION_DATE).repartitionByRange(2, STATION_YEAR), f"{source}/d_dateless")
    strange = rows.withColumn(STATION_YEAR, F.concat(F.lit("no "), column(STATION_YEAR)))
    _write_csv(strange.repartitionByRange(2, STATION_YEAR), f"{source}/e_strange")
    years = [r[0] for r in rows.select(column(STATION_YEAR)).distinct().collect()]
    state = scratch_dir(spark, "stream")
    query = start_station_load(spark, f"{source}/*", years, path, state, files_per_batch=9)
    query.awaitTermination()
    return cl.to_wide(read_items(spark, path))


def _write_station_set(spark: SparkSession, sf: str) -> str:
    """Files with three headers: plain in odd years, without quality in 1997, else reversed."""
    base = scratch_dir(spark, "stations")
    st.climate(spark, sf).write.parquet(f"{base}-rows")
    rows = spark.read.parquet(f"{base}-rows")
    year, names = column(STATION_YEAR).cast("int"), rows.columns
    layouts = {
        "a_odd": (names, (year % 2 == 1) & (year != 1997)),
        "b_1997": ([c for c in names if c != "Data Quality"], year == 1997),
        "c_even": (names[::-1], year % 2 == 0),
    }
    for folder, (header, wanted) in layouts.items():
        _write_csv(rows.where(wanted).select(*[column(c) for c in header]), f"{base}/{folder}")
    return f"{base}/*/*.csv"


def union_csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Files of different headers combined into one CSV table, read back."""
    target = scratch_dir(spark, "combined")
    combine_stations(spark, _write_station_set(spark, sf), target)
    return read_csv_set(spark, f"{target}/*.csv", missing=())


def union_csv_with_index(spark: SparkSession, sf: str) -> DataFrame:
    """Every row with its number beside the number it should have: the files of a kind
    hold ranges of days in the order of their paths."""
    base = scratch_dir(spark, "numbered")
    days = st.climate(spark, sf).select(
        column(STATION_YEAR).cast("int").alias("y"), column(STATION_DATE).alias("d")
    )
    days = days.withColumn("day", short_date(F.col("d")))
    for folder, wanted in (("a odd", "y % 2 = 1"), ("b [even]", "y % 2 = 0")):
        part = days.where(wanted).select(F.col("y").alias("Year"), "d", F.lit(folder).alias("kind"), "day")
        ranges = part.repartitionByRange(8, "day").sortWithinPartitions("day").drop("day")
        _write_csv(ranges if "odd" in folder else ranges.select("kind", "d", "Year"), f"{base}/{folder}")
    files = f"{base}/*/*.csv"
    rows = read_csv_set(spark, files, missing=(), with_split=True)
    return combine.with_row_index(rows, combine.SPLIT_KEYS).select(
        "row_index", "kind", F.col("d").alias("date_text")
    )


# Landing and publication


def scan_landing_csv(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "landing")
    _write_csv(
        st.inventory(spark, sf).select(*INVENTORY.names),
        landing_path(base, "inventory", RUN_DATE),
    )
    return read_landing(spark, base, "inventory", RUN_DATE, INVENTORY)


def landing_completeness(spark: SparkSession, sf: str) -> DataFrame:
    result = landing.completeness(st.listing(spark, sf), prefix="in")
    return result.withColumn("missing", F.array_join("missing", ","))


def landing_missing(spark: SparkSession, sf: str) -> DataFrame:
    return landing.missing_files(st.listing(spark, sf), prefix="in")


def _land_day(spark: SparkSession, sf: str) -> str:
    base = scratch_dir(spark, "landing")
    _write_csv(
        st.inventory(spark, sf).select(*INVENTORY.names),
        landing_path(base, "inventory", RUN_DATE),
    )
    _write_csv(
        st.sales(spark, sf).select(*SALES.names), landing_path(base, "sales", RUN_DATE)
    )
    return base


def landing_file_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The listing of a landing folder as data: whether there are files, and how many
    bytes they hold beside their header lines."""
    files = list_landing(spark, f"{_land_day(spark, sf)}/*_{RUN_DATE}.csv")
    named = landing.landed_files(files, keep=("length",))
    headers = {"inventory": INVENTORY.names, "sales": SALES.names}
    header = F.coalesce(*[F.when(F.col("table_name") == t, len(",".join(n)) + 1) for t, n in headers.items()])
    return named.groupBy("table_name").agg(
        (F.count(F.lit(1)) > 0).alias("landed"), F.sum(F.col("length") - header).alias("row_bytes")
    )


def landing_gate(spark: SparkSession, sf: str) -> DataFrame:
    """A complete day and one without sales through the gate: what each lacks, and how many
    dimension rows each published."""
    base, result = _land_day(spark, sf), scratch_dir(spark, "result")
    for name in publish.DIMENSION_TABLES:
        _write_csv(st.dimension(spark, sf, name), landing_path(base, name, RUN_DATE))
    later = "2002-01-02"
    for name in (*publish.DIMENSION_TABLES, "inventory"):
        day = read_landing(spark, base, name, RUN_DATE)
        _write_csv(day, landing_path(base, name, later))
    parts = []
    for date in (RUN_DATE, later):
        target = f"{result}/{date}"
        lacks = run_gate(spark, base, f"{target}/archive", target, date)
        # Counts what is there, whatever the gate has said.
        nothing = list_landing(spark, f"{target}/*.csv").isEmpty()
        tables = () if nothing else publish.DIMENSION_TABLES
        rows = [read_copy(spark, f"{target}/{t}.csv").select(F.lit(1)) for t in tables]
        total = reduce(DataFrame.unionAll, rows, spark.range(0).select(F.lit(1)))
        parts.append(
            total.agg(F.count(F.lit(1)).alias("published_rows")).select(
                F.lit(date).alias("file_date"), F.lit(",".join(lacks)).alias("missing"), "published_rows"
            )
        )
    return reduce(DataFrame.unionAll, parts)


def read_copy(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.option("header", True).option("escape", '"').option("nullValue", NULL_TEXT)
    return reader.option("multiLine", True).csv(path)


def dq_suite_table(spark: SparkSession, sf: str) -> DataFrame:
    """The suite over a table registered in the catalog."""
    path = scratch_dir(spark, "raw")
    name = "raw_" + path.rsplit("-", 1)[1]
    st.inventory_raw(spark, sf).write.parquet(path)
    publish.register_table(spark, name, path)
    return _unregistered(dq.run_suite(read_table(spark, name), dq.INVENTORY_SUITE), name)


def publish_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Two days archived, read back as one partitioned table."""
    archive = scratch_dir(spark, "archive")
    path = publish.publish_archive(weekly_inventory_summary(spark, sf), archive, RUN_DATE, files=4)
    publish.publish_archive(spark.read.parquet(path), archive, "2002-01-02", files=4)
    return spark.read.parquet(archive)


def publish_current(spark: SparkSession, sf: str) -> DataFrame:
    """The whole weekly job from landed files to the current snapshot."""
    path = run_weekly(
        spark,
        _land_day(spark, sf),
        RUN_DATE,
        scratch_dir(spark, "archive"),
        scratch_dir(spark, "result"),
        files=4,
    )
    return spark.read.parquet(path)


def catalog_registered_summary(spark: SparkSession, sf: str) -> DataFrame:
    archive = scratch_dir(spark, "archive")
    publish.publish_archive(weekly_inventory_summary(spark, sf), archive, RUN_DATE)
    name = "summary_" + archive.rsplit("-", 1)[1]
    publish.register_table(spark, name, archive)
    rows = spark.sql(
        f"""
        SELECT store_key, weekly_summary, count(*) AS weeks_and_products,
               sum(low_stock_instances) AS low_stock_instances,
               max(stock_level_EOW) AS highest_stock_level
        FROM {name} GROUP BY store_key, weekly_summary
        """
    )
    return _unregistered(rows, name)


def catalog_widened_days(spark: SparkSession, sf: str) -> DataFrame:
    """Three days whose columns grew: narrow counts and no order level first, then the whole
    summary, then without a price. Registered after each day, read as one table."""
    archive = scratch_dir(spark, "archive")
    name = "days_" + archive.rsplit("-", 1)[1]
    publish.publish_archive(weekly_inventory_summary(spark, sf), archive, "2002-01-02")
    whole = spark.read.parquet(publish.archive_path(archive, "2002-01-02"))
    narrow = whole.drop("order_level_EOW").withColumns(
        {
            "low_stock_instances": F.col("low_stock_instances").cast("int"),
            "total_sales_qty": F.col("total_sales_qty").cast("float"),
        }
    )
    publish.publish_archive(narrow, archive, RUN_DATE)
    publish.register_table(spark, name, archive)
    publish.publish_archive(whole.drop("avg_sales_price"), archive, "2002-01-03")
    rows = publish.register_table(spark, name, archive)
    found = rows.groupBy("weekly_summary").agg(
        F.count(F.lit(1)).alias("weeks"),
        F.sum("low_stock_instances").alias("low_stock_instances"),
        F.sum("total_sales_qty").alias("total_sales_qty"),
        F.count("order_level_EOW").alias("order_levels"),
        F.count("avg_sales_price").alias("prices"),
    )
    return _unregistered(found, name)


def publish_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    """Dimensions copied from landing; rows of both copies, all tables in one shape, and
    whether every file of the copy has the bytes of its source. One table has quotes, line
    breaks, backslashes, empty and absent values, one has other line ends."""
    base, archive, result = (scratch_dir(spark, n) for n in ("landing", "archive", "result"))
    for name in publish.DIMENSION_TABLES:
        rows = st.awkward(st.dimension(spark, sf, name), name)
        _write_csv(rows, landing_path(base, name, RUN_DATE), "\r\n" if name == "calendar" else "\n")
    report = publish.publish_dimensions(spark, base, RUN_DATE, archive, result)

    def copy(name: str, kind: str, path: str) -> DataFrame:
        rows = read_copy(spark, path)
        values = [F.col(c) for c in rows.columns] + [F.lit(None).cast("string")] * (3 - len(rows.columns))
        named = [v.alias(f"value_{i}") for i, v in enumerate(values, 1)]
        files = report.where(F.startswith("target", F.lit(f"{publish.qualified(spark, path)}/")))
        same = files.agg(F.bool_and(F.col("source_sha256") == F.col("copy_sha256"))).first()[0]
        return rows.select(
            F.lit(name).alias("table_name"), F.lit(kind).alias("copy"), *named, F.lit(same).alias("same_bytes")
        )

    parts = [
        copy(name, kind, path)
        for name in publish.DIMENSION_TABLES
        for kind, path in zip(
            ("archive", "current"), publish.dimension_targets(archive, result, name, RUN_DATE)
        )
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "weekly_inventory_summary": weekly_inventory_summary,
    "weekly_summary_by_date": weekly_summary_by_date,
    "weekly_summary_text_compare": weekly_summary_text_compare,
    "daily_fact": _fact,
    "low_stock_flag": low_stock_flag,
    "week_calendar": week_calendar,
    "last_inventory_of_week": last_inventory_of_week,
    "weekly_eow_levels": weekly_eow_levels,
    "weekly_stock_impact": weekly_stock_impact,
    "dq_not_null": dq_not_null,
    "dq_in_set": dq_in_set,
    "dq_between": dq_between,
    "dq_unique": dq_unique,
    "dq_suite_inventory": dq_suite_inventory,
    "dq_suite_sales": dq_suite_sales,
    "dq_suite_summary": dq_suite_summary,
    "dq_suite_query": dq_suite_query,
    "dq_suite_sample": dq_suite_sample,
    "dq_suite_table": dq_suite_table,
    "climate_attribute_names": climate_attribute_names,
    "climate_date_parse": climate_date_parse,
    "climate_sparse_attributes": climate_sparse_attributes,
    "climate_year_load": climate_year_load,
    "climate_range_query": climate_range_query,
    "climate_upsert_latest": climate_upsert_latest,
    "climate_export_csv": climate_export_csv,
    "climate_stream_load": climate_stream_load,
    "union_csv_by_name": union_csv_by_name,
    "union_csv_with_index": union_csv_with_index,
    "scan_landing_csv": scan_landing_csv,
    "landing_completeness": landing_completeness,
    "landing_missing": landing_missing,
    "landing_file_sizes": landing_file_sizes,
    "landing_gate": landing_gate,
    "publish_archive": publish_archive,
    "publish_current": publish_current,
    "catalog_registered_summary": catalog_registered_summary,
    "catalog_widened_days": catalog_widened_days,
    "publish_dimensions": publish_dimensions,
}
