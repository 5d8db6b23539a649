"""Station files: names, dates, sparse items, upsert log, range query, export, stream."""

import csv
import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stockglass.functions.dates import iso_date, short_date
from stockglass.functions.names import header_names
from stockglass.functions.text import attribute_name, has_text
from stockglass.operators import climate as cl
from stockglass.plans.stations import extract_range, load_station_file, load_stations
from stockglass.sources import items as log
from stockglass.sources.csv_set import read_station_files
from stockglass.streaming.stations import start_station_load

HEADER = ["Year", "Date/Time", "Max Temp (°C)", "Data Quality"]
TYPES = "`Year` string, `Date/Time` string, `Max Temp (°C)` string, `Data Quality` string"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, TYPES)


def items_of(df):
    return {(r.year, r.date): r.attributes for r in df.collect()}


def put(folder, name, *rows, header=HEADER):
    Path(folder).mkdir(parents=True, exist_ok=True)
    with open(Path(folder) / name, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])


def test_attribute_names():
    assert attribute_name("Max Temp (°C)") == "max-temp-c"
    assert attribute_name("Data Quality") == "data-quality"
    assert attribute_name("Spd of Max Gust (km/h)") == "spd-of-max-gust-km/h"


def test_header_names():
    assert header_names('﻿"a",b') == ["a", "b"]
    assert header_names("Flag,Flag,,Flag") == ["Flag", "Flag.1", "Unnamed: 2", "Flag.2"]
    assert header_names('"x, y",z') == ["x, y", "z"]
    with pytest.raises(ValueError):
        header_names("Date,date")


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2/9/69", "1969-02-09"),
        ("2/9/68", "2068-02-09"),
        ("12/31/99", "1999-12-31"),
        ("01/01/00", "2000-01-01"),
        ("02/29/96", "1996-02-29"),
        ("02/29/97", None),
        ("31/31/20", None),
        ("02/30/20", None),
        ("2/9/2020", None),
        (" 2/9/20", None),
        ("002/9/20", None),
        ("", None),
        (None, None),
    ],
)
def test_short_dates(spark, text, day):
    df = spark.createDataFrame([(text,)], "v string")
    got = df.select(short_date(F.col("v")).alias("d"), iso_date(short_date(F.col("v"))).alias("i"))
    assert tuple(got.first()) == (day and dt.date.fromisoformat(day), day)


def test_two_digit_years_in_spark(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1969-01-01', DATE'2068-12-31')) AS d")
    # Python reads 69-99 as 19xx and 00-68 as 20xx; these are the dates it can name.
    text = F.date_format("d", "MM/dd/yy")
    assert days.where(~short_date(text).eqNullSafe(F.col("d"))).count() == 0


def test_has_text_knows_all_white_space(spark):
    values = [None, "", " ", "\t\n", " ", " ", "\x1c\x1f", " 1 ", "x"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.t for r in df.orderBy("i").select(has_text(F.col("v")).alias("t")).collect()]
    assert got == [bool(v and v.strip()) for v in values]


def test_items_are_sparse_unstripped_and_of_one_year(spark):
    df = rows_of(
        spark,
        [
            ("2020", "2/9/20", " 1 ", " "),
            ("2020", "02/10/20", None, "ok"),
            ("2019", "bad", "1", "1"),
            ("2020", "31/31/20", "9", "9"),
            (" 2020", "1/1/20", "9", "9"),
        ],
    )
    items, rejects = cl.station_items(df, 2020)
    assert items_of(items) == {
        ("2020", "2020-02-09"): {"max-temp-c": " 1 "},
        ("2020", "2020-02-10"): {"data-quality": "ok"},
    }
    assert [r["Date/Time"] for r in rejects.collect()] == ["31/31/20"]
    assert rejects.columns == HEADER


def test_columns_of_one_name_and_key_names(spark):
    df = spark.createDataFrame(
        [("2020", "1/1/20", "a", " ", None), ("2020", "1/2/20", "a", "b", "2020-09-09")],
        "`Year` string, `Date/Time` string, `Rain (mm)` string, `rain mm` string, `Date` string",
    )
    items, _ = cl.station_items(df, 2020)
    assert items_of(items) == {
        ("2020", "2020-01-01"): {"rain-mm": "a"},
        ("2020", "2020-09-09"): {"rain-mm": "b"},
    }


def test_only_key_columns(spark):
    df = spark.createDataFrame([("2020", "1/1/20")], "`Year` string, `Date/Time` string")
    items, _ = cl.station_items(df, "2020")
    assert items_of(items) == {("2020", "2020-01-01"): {}}


def test_put_replaces_the_whole_item_and_replay_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "items")
    assert log.read_items(spark, path).count() == 0 and log.next_batch_id(spark, path) == 0
    first = rows_of(spark, [("2020", "1/1/20", "1", "2"), ("2020", "1/2/20", "3", "4")])
    second = rows_of(spark, [("2020", "1/1/20", "9", None)])
    wanted = {
        ("2020", "2020-01-01"): {"max-temp-c": "9"},
        ("2020", "2020-01-02"): {"max-temp-c": "3", "data-quality": "4"},
    }
    load_stations(first, 2020, path, 0)
    for _ in range(2):
        load_stations(second, 2020, path, 1)
        assert items_of(log.read_items(spark, path)) == wanted
        assert log.read_log(spark, path).count() == 3
    load_stations(first, 2020, path, 0)
    assert items_of(log.read_items(spark, path)) == wanted
    assert log.next_batch_id(spark, path) == 2
    compact = str(tmp_path / "compact")
    log.compact_items(spark, path, compact)
    assert items_of(log.read_items(spark, compact)) == wanted
    assert log.read_log(spark, compact).count() == 2


def test_last_row_of_a_file_and_later_path_win(spark, tmp_path):
    put(tmp_path / "in", "a.csv", ["2020", "1/1/20", "1", ""], ["2020", "1/1/20", "2", ""])
    rows = read_station_files(spark, str(tmp_path / "in" / "*.csv"))
    items, _ = cl.station_items(rows, 2020)
    assert items_of(cl.last_per_key(items)) == {("2020", "2020-01-01"): {"max-temp-c": "2"}}


def test_hot_key_sends_one_row_per_task(spark, tmp_path):
    rows = spark.range(20000, numPartitions=4).select(
        F.lit("2020").alias("Year"),
        F.when(F.col("id") % 3 == 0, "1/1/20").otherwise(F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 365).cast("int")), "M/d/yy")).alias("Date/Time"),
        F.col("id").cast("string").alias("Value"),
    )
    items, _ = cl.station_items(rows, 2020)
    got = items_of(cl.last_per_key(items))
    assert len(got) == 365
    assert got["2020", "2020-01-01"] == {"value": "19998"}


def test_load_reports_and_keeps_rejects(spark, tmp_path):
    put(tmp_path / "in", "a.csv", ["2020", "1/1/20", "1", ""], ["2020", "13/1/20", "2", ""], ["2019", "x", "", ""])
    path, rejects = str(tmp_path / "items"), str(tmp_path / "rejects")
    report = load_station_file(
        spark, str(tmp_path / "in/a.csv"), 2020, path, 0, table="station_items", rejects_path=rejects
    )
    assert (report.rows, report.rejected) == (2, 1)
    assert spark.table("station_items").count() == 1
    bad = spark.read.parquet(rejects).first()
    assert bad["Date/Time"] == "13/1/20" and bad["_arrival"].path.endswith("a.csv")
    log.ensure_items_table(spark, "station_items", path)  # exists already
    spark.sql("DROP TABLE station_items")


def test_range_query_prunes_years_and_is_inclusive(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = rows_of(spark, [(y, f"{m}/15/{y[2:]}", "1", "") for y in ("2019", "2020") for m in range(1, 13)])
    load_stations(rows, (2019, 2020), path, 0)
    found = cl.range_query(log.read_items(spark, path), 2020, "2020-03-15", "2020-05-15")
    assert [r.date for r in found.collect()] == ["2020-03-15", "2020-04-15", "2020-05-15"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(date,2020-03-15)" in plan


def test_extract_writes_union_of_keys_or_nothing(spark, tmp_path):
    path = str(tmp_path / "items")
    load_stations(
        rows_of(spark, [("2020", "1/2/20", " 1 ", None), ("2020", "1/1/20", None, 'say "x"')]), 2020, path, 0
    )
    out = tmp_path / "out"
    assert extract_range(spark, path, 2020, "2020-01-01", "2020-12-31", str(out)) == 2
    (part,) = out.glob("*.csv")
    with open(part, newline="", encoding="utf-8") as f:
        assert list(csv.reader(f)) == [
            ["year", "date", "data-quality", "max-temp-c"],
            ["2020", "2020-01-01", 'say "x"', ""],
            ["2020", "2020-01-02", "", " 1 "],
        ]
    none = tmp_path / "none"
    assert extract_range(spark, path, 2021, "2021-01-01", "2021-12-31", str(none)) == 0
    assert not none.exists()


def test_stream_loads_new_files_once(spark, tmp_path):
    source, path, state = tmp_path / "in", str(tmp_path / "items"), str(tmp_path / "state")

    def run():
        start_station_load(spark, str(source), [2019, 2020], path, state).awaitTermination()
        return items_of(log.read_items(spark, path))

    put(source, "a.csv", ["2020", "1/1/20", "1", "q"], ["2019", "1/1/19", "5", ""], ["2018", "1/1/18", "5", ""])
    assert len(run()) == 2
    put(source, "b.csv", ["2020", "1/1/20", "7", ""])
    assert run() == {
        ("2020", "2020-01-01"): {"max-temp-c": "7"},
        ("2019", "2019-01-01"): {"max-temp-c": "5"},
    }
    batches = log.read_log(spark, path).select("batch_id").distinct().count()
    assert run() and log.read_log(spark, path).select("batch_id").distinct().count() == batches == 2


def test_stream_splits_a_backlog_and_the_later_batch_wins(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "items")
    for i in range(3):
        put(source, f"{i}.csv", ["2020", "1/1/20", str(i), ""], ["2020", f"1/{i + 2}/20", "x", ""])
        os.utime(source / f"{i}.csv", (1_600_000_000 + i, 1_600_000_000 + i))
    start_station_load(
        spark, str(source), 2020, path, str(tmp_path / "state"), files_per_batch=1, first_batch_id=5
    ).awaitTermination()
    batches = {r.batch_id for r in log.read_log(spark, path).select("batch_id").collect()}
    assert batches == {5, 6, 7}
    items = items_of(log.read_items(spark, path))
    assert len(items) == 4 and items["2020", "2020-01-01"] == {"max-temp-c": "2"}


def test_stream_takes_any_header_and_quarantines_what_it_cannot_load(spark, tmp_path):
    source, path = tmp_path / "in x", str(tmp_path / "items")
    put(source, "a.csv", ["2020", "1/1/20", "1", "q"])
    put(source, "b[1].csv", ["7", "2020", "1/2/20", "q"], header=["Max Temp (°C)", "Year", "Date/Time", "Data Quality"])
    put(source, "c.csv", ["1/3/20", "new", "2020"], header=["Date/Time", "Snow (cm)", "Year"])
    put(source, "d.csv", ["2020", "1/4/20"], header=["Year", "Day"])
    put(source, "e.csv", ["2020", "1/5/20", "1", "2"], header=["Year", "Date/Time", "Rain", "rain"])
    put(source, "f.csv", ["2020", "1/6/20", "1"], header=["Year", "Date/Time", "MAX TEMP (°C)"])
    (source / "g.csv").write_text("\n")
    (source / "nothing.csv").write_text("")  # without a byte it does not arrive
    (source / "h.csv").write_text("Year,Date/Time\n")
    start_station_load(spark, str(source), 2020, path, str(tmp_path / "state")).awaitTermination()
    wanted = {
        ("2020", "2020-01-01"): {"max-temp-c": "1", "data-quality": "q"},
        ("2020", "2020-01-02"): {"max-temp-c": "7", "data-quality": "q"},
        ("2020", "2020-01-03"): {"snow-cm": "new"},
    }
    assert items_of(log.read_items(spark, path)) == wanted
    put_aside = {Path(r.path).name: r.reason for r in spark.read.parquet(f"{path}-quarantine").collect()}
    assert put_aside == {
        "d.csv": "no column Date/Time",
        "e.csv": "columns 'Rain' and 'rain' differ only in case",
        "f.csv": "columns 'Max Temp (°C)' and 'MAX TEMP (°C)' differ only in case",
        "g.csv": "no column Year, Date/Time",
    }
    report = spark.read.parquet(f"{path}-reports").first()
    assert (report.rows, report.files, report.quarantined) == (3, 8, 4)


def test_a_batch_that_failed_half_way_is_replayed_exactly(spark, tmp_path, monkeypatch):
    """The log is written, the report is not; the stream starts again with the same files."""
    from stockglass.streaming import stations as streaming

    source, path, state = tmp_path / "in", str(tmp_path / "items"), str(tmp_path / "state")
    put(source, "a.csv", ["2020", "1/1/20", "1", ""], ["2020", "99/1/20", "1", ""])
    put(source, "b.csv", ["x"], header=["Year"])
    real = streaming.load_stations
    monkeypatch.setattr(streaming, "load_stations", lambda *a: real(*a) and 1 / 0)
    with pytest.raises(PySparkException):
        start_station_load(spark, str(source), 2020, path, state).awaitTermination()
    assert len(items_of(log.read_items(spark, path))) == 1
    monkeypatch.setattr(streaming, "load_stations", real)
    put(source, "c.csv", ["2020", "1/1/20", "3", ""])
    start_station_load(spark, str(source), 2020, path, state).awaitTermination()
    assert items_of(log.read_items(spark, path)) == {("2020", "2020-01-01"): {"max-temp-c": "3"}}
    counts = spark.read.parquet(f"{path}-reports").orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r.rejected, r.files, r.quarantined) for r in counts] == [(0, 2, 1, 2, 1), (1, 1, 0, 1, 0)]
    assert log.read_log(spark, path).count() == 2
    assert spark.read.parquet(f"{path}-rejects").count() == 1


def test_a_file_without_a_wanted_row_is_an_empty_batch(spark, tmp_path):
    put(tmp_path / "in", "a.csv", ["2019", "1/1/19", "1", ""])
    put(tmp_path / "in", "b.csv", ["2020", "x", "1", ""], ["2020", "31/31/20", "2", ""])
    path, rejects = str(tmp_path / "items"), str(tmp_path / "rejects")
    report = load_station_file(spark, str(tmp_path / "in/a.csv"), 2020, path, 0, rejects_path=rejects)
    assert (report.rows, report.rejected, report.duplicates) == (0, 0, 0)
    assert log.read_items(spark, path).count() == 0 and not (tmp_path / "rejects").exists()
    report = load_station_file(spark, str(tmp_path / "in/b.csv"), 2020, path, 1, rejects_path=rejects)
    assert (report.rows, report.rejected, report.duplicates) == (2, 2, 0)
    assert {r["Date/Time"] for r in spark.read.parquet(rejects).collect()} == {"x", "31/31/20"}


def test_duplicates_are_counted_and_years_may_be_left_out(spark, tmp_path):
    rows = rows_of(spark, [("2020", "1/1/20", "1", ""), ("2020", "1/1/20", "2", ""), ("2019", "1/1/19", "3", "")])
    report = load_stations(rows, None, str(tmp_path / "items"), 0)
    assert (report.rows, report.rejected, report.duplicates) == (3, 0, 1)


def test_a_batch_written_again_loses_its_old_years(spark, tmp_path):
    path = str(tmp_path / "items")
    load_stations(rows_of(spark, [("2019", "1/1/19", "1", ""), ("2020", "1/1/20", "1", "")]), None, path, 0)
    log.ensure_items_table(spark, "batches", path)
    log.sync_items_table(spark, "batches")
    assert spark.table("batches").count() == 2
    load_stations(rows_of(spark, [("2020", "1/1/20", "2", "")]), None, path, 0)
    wanted = {("2020", "2020-01-01"): {"max-temp-c": "2"}}
    assert items_of(log.read_items(spark, path)) == wanted
    log.sync_items_table(spark, "batches")
    assert items_of(log.latest_items(spark.table("batches"))) == wanted
    spark.sql("DROP TABLE batches")


def test_stream_goes_on_after_a_batch_without_a_wanted_row(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "items")
    files = (["2018", "1/1/18", "1", ""], ["2020", "bad", "2", ""], ["2020", "1/1/20", "3", ""])
    for i, row in enumerate(files):
        put(source, f"{i}.csv", row)
        os.utime(source / f"{i}.csv", (1_600_000_000 + i, 1_600_000_000 + i))
    start_station_load(spark, str(source), 2020, path, str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    assert items_of(log.read_items(spark, path)) == {("2020", "2020-01-01"): {"max-temp-c": "3"}}
    reports = spark.read.parquet(f"{path}-reports").orderBy("batch_id").collect()
    assert [(r.rows, r.rejected) for r in reports] == [(0, 0), (1, 1), (1, 0)]
    assert spark.read.parquet(f"{path}-rejects").first()["Date/Time"] == "bad"
