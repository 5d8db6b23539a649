"""Landing gate, weekly job, publication, catalog."""

import datetime as dt
import hashlib
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stockglass.operators.landing import completeness, landed_files, missing_files
from stockglass.plans import weekly
from stockglass.plans.gate import day_before, run_gate
from stockglass.plans.validation import validate_raw
from stockglass.plans.weekly import run_weekly
from stockglass.schemas import INVENTORY, REQUIRED_TABLES, SALES
from stockglass.sinks import copies
from stockglass.sinks.publish import archive_path, publish_archive, publish_current, register_table
from stockglass.sources.items import read_items, upsert_items
from stockglass.sources.landing import list_landing, misfits, read_landing

DAY = "2023-05-05"
FILES = {
    "inventory": "cal_dt,store_key,prod_key,inventory_on_hand_qty,inventory_on_order_qty,out_of_stock_flg\n"
    "2023-05-05,0200,7,10.50,4,1\n",
    "sales": "trans_id,trans_dt,store_key,prod_key,sales_qty,sales_amt,sales_cost,discount\n"
    "1,2023-05-05,0200,7,2,9.99,5,0\n2,2023-05-05,200,7,20,90.5,50,0.1\n",
    "calendar": "cal_dt,wk\n2023-05-05,18\n",
    "store": "store_key,name\n0200, North \n",
    "product": "prod_key,name\n7,ring\n",
}


def land(folder, tables=tuple(FILES), day=DAY):
    Path(folder).mkdir(parents=True, exist_ok=True)
    for t in tables:
        (Path(folder) / f"{t}_{day}.csv").write_text(FILES[t], encoding="utf-8")


def listing(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_completeness_and_missing(spark):
    paths = [f"in/{t}_2020-01-01.csv" for t in REQUIRED_TABLES]
    paths += ["in/sales_2020-01-02.csv", "in/store_2020-01-02.csv", "in/store_2020-01-02.csv"]
    paths += ["in/extra_2020-01-03.csv", "in/sales_2020-01-04.csv.tmp", "other/sales_2020-01-05.csv"]
    df = listing(spark, *paths)
    got = {r.file_date: r for r in completeness(df, prefix="in").collect()}
    assert set(got) == {"2020-01-01", "2020-01-02"}
    assert got["2020-01-01"].complete and got["2020-01-01"].missing == []
    assert not got["2020-01-02"].complete and got["2020-01-02"].present_count == 2
    assert got["2020-01-02"].missing == ["calendar", "inventory", "product"]
    missing = {(r.file_date, r.table_name) for r in missing_files(df, prefix="in").collect()}
    assert missing == {("2020-01-02", t) for t in ("calendar", "inventory", "product")}
    day = spark.createDataFrame([("2020-01-09",)], "file_date string")
    assert missing_files(df, day, prefix="in").count() == 5
    assert landed_files(df).where("file_date = '2020-01-05'").count() == 1


def test_listing_of_a_folder(spark, tmp_path):
    land(tmp_path)
    rows = list_landing(spark, f"{tmp_path}/*_{DAY}.csv")
    assert rows.count() == 5 and rows.columns == ["path", "length", "modificationTime"]
    assert list_landing(spark, f"{tmp_path}/*_2000-01-01.csv").count() == 0


def test_gate_publishes_only_a_complete_day(spark, tmp_path):
    base, archive, result = (str(tmp_path / n) for n in ("in", "out/dimensions", "result"))
    land(base, ["sales", "store", "calendar"])
    assert run_gate(spark, base, archive, result, DAY) == ["inventory", "product"]
    assert not Path(result).exists()
    land(base)
    assert run_gate(spark, base, archive, result, DAY) == []
    for path in (f"{archive}/store_{DAY}.csv", f"{result}/store.csv"):
        rows = spark.read.option("header", True).csv(path).collect()
        assert [tuple(r) for r in rows] == [("0200", " North ")]
    assert day_before(dt.date(2023, 3, 1)) == "2023-02-28"


def test_typed_scan_goes_by_name(spark, tmp_path):
    land(tmp_path)
    assert read_landing(spark, str(tmp_path), "inventory", DAY, INVENTORY).first().store_key == 200
    assert read_landing(spark, str(tmp_path), "inventory", DAY).first().store_key == "0200"
    swapped = "prod_key,note,out_of_stock_flg,inventory_on_order_qty,inventory_on_hand_qty,store_key,cal_dt\n"
    (tmp_path / f"inventory_{DAY}.csv").write_text(swapped + "7,x,1,none,10.5,200,2023-05-05\n")
    row = read_landing(spark, str(tmp_path), "inventory", DAY, INVENTORY).first()
    assert tuple(row) == (dt.date(2023, 5, 5), 200, 7, Decimal("10.50"), None, 1)


def test_extract_of_files_with_different_headers_stops(spark, tmp_path):
    folder = tmp_path / f"store_{DAY}.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_landing(spark, str(tmp_path), "store", DAY).collect()


def test_weekly_job(spark, tmp_path):
    base, archive, result = (str(tmp_path / n) for n in ("in", "out", "result"))
    land(base)
    path = run_weekly(spark, base, DAY, archive, result, files=4, table="current_summary")
    (row,) = spark.table("current_summary").collect()
    assert row.wk_timestamp == dt.datetime(2023, 5, 1)
    assert (row.total_sales_qty, row.stock_level_EOW, row.low_stock_instances) == (22.0, 21.0, 1)
    assert row.no_stock_impact == pytest.approx(100.49)
    assert path == f"{result}/weekly_summary"
    assert all(".gz." in f.name for f in Path(path).glob("*.parquet"))
    assert spark.read.parquet(archive_path(archive, DAY)).collect() == [row]
    run_weekly(spark, base, DAY, archive, result, compare_as_text=True)
    (text,) = spark.read.parquet(path).collect()
    # Text keys: only the sale written '0200' meets the reading; '2' < '10.50' is false as text.
    assert (text.store_key, text.total_sales_qty, text.low_stock_instances) == ("0200", 2.0, 0)
    spark.sql("DROP TABLE current_summary")
    with pytest.raises(ValueError):
        run_weekly(spark, base, "", archive, result)


def test_archive_keeps_other_days(spark, tmp_path):
    archive = str(tmp_path)
    publish_archive(spark.range(3), archive, "2020-01-01", files=2)
    publish_archive(spark.range(5), archive, "2020-01-02")
    publish_archive(spark.range(4), archive, "2020-01-02")
    table = register_table(spark, "archived", archive)
    counts = {str(r.weekly_summary): r["count"] for r in table.groupBy("weekly_summary").count().collect()}
    assert counts == {"2020-01-01": 3, "2020-01-02": 4}
    publish_archive(spark.range(6), archive, "2020-01-03")
    assert register_table(spark, "archived", archive).count() == 13
    spark.sql("DROP TABLE archived")


def test_validation_job(spark, tmp_path):
    land(tmp_path)
    for t, schema in (("inventory", INVENTORY), ("sales", SALES)):
        read_landing(spark, str(tmp_path), t, DAY, schema).createOrReplaceTempView(f"landed_{t}")
    results, stats = validate_raw(spark, "landed_inventory", "landed_sales")
    assert results.count() == 7 and results.where("not success").count() == 0
    assert stats.count() == 2


def test_values_no_type_holds_are_found(spark, tmp_path):
    text = "trans_id,trans_dt,store_key,prod_key,sales_qty,sales_amt,sales_cost,discount\n"
    text += "1,2023-05-05,S1,7,2,9.99,5,0\n2,2023-05-05,200.0,7,12345678901.5,1,1,0\n"
    text += "3,2023-05-05,200,7,0.125,1,1,0\n4,2023-05-05,200,,2.50,1,1,0\n"
    (tmp_path / f"sales_{DAY}.csv").write_text(text)
    bad = {r.trans_id: r.misfits for r in misfits(read_landing(spark, str(tmp_path), "sales", DAY), SALES).collect()}
    assert bad == {"1": ["store_key"], "2": ["sales_qty"], "3": ["sales_qty"]}
    typed = {r.trans_id: r.store_key for r in read_landing(spark, str(tmp_path), "sales", DAY, SALES).collect()}
    assert typed == {1: None, 2: 200, 3: 200, 4: 200}


def test_weekly_job_keeps_misfits(spark, tmp_path):
    base, result = str(tmp_path / "in"), str(tmp_path / "result")
    land(base)
    run_weekly(spark, base, DAY, str(tmp_path / "out"), result)
    assert not (tmp_path / "result/misfits").exists()
    with open(f"{base}/sales_{DAY}.csv", "a") as f:
        f.write("3,2023-05-05,S1,7,2,1,1,0\n")
    run_weekly(spark, base, DAY, str(tmp_path / "out"), result)
    (row,) = spark.read.parquet(f"{result}/misfits/sales_{DAY}.csv").collect()
    assert row.store_key == "S1" and row.misfits == ["store_key"]


def test_an_extract_without_misfits_is_read_once(spark, tmp_path, monkeypatch):
    base, read = str(tmp_path / "in"), []
    land(base)
    monkeypatch.setattr(weekly, "misfits", lambda rows, schema: read.append(schema) or misfits(rows, schema))
    run_weekly(spark, base, DAY, str(tmp_path / "out"), str(tmp_path / "result"))
    assert read == []
    with open(f"{base}/inventory_{DAY}.csv", "a") as f:
        f.write("2023-05-05,200,x,1,1,0\n2023-05-05,200,7,1.234,1,0\n")
    run_weekly(spark, base, DAY, str(tmp_path / "out"), str(tmp_path / "result"))
    assert read == [INVENTORY]
    bad = spark.read.parquet(f"{tmp_path}/result/misfits/inventory_{DAY}.csv").collect()
    assert sorted(r.misfits[0] for r in bad) == ["inventory_on_hand_qty", "prod_key"]


def test_misfits_are_kept_beside_an_empty_table(spark, tmp_path):
    base = tmp_path / "in"
    land(base)
    (base / f"inventory_{DAY}.csv").write_text(FILES["inventory"].splitlines()[0] + "\n")
    with open(base / f"sales_{DAY}.csv", "a") as f:
        f.write("3,2023-05-05,S1,7,2,1,1,0\n")
    run_weekly(spark, str(base), DAY, str(tmp_path / "out"), str(tmp_path / "result"))
    (row,) = spark.read.parquet(f"{tmp_path}/result/misfits/sales_{DAY}.csv").collect()
    assert row.store_key == "S1"


def test_a_write_that_fails_half_way_leaves_the_old_snapshot(spark, tmp_path):
    archive, result = str(tmp_path / "archive"), str(tmp_path / "result")
    publish_archive(spark.range(100), archive, DAY)
    current = publish_current(spark, archive, DAY, result)
    # Some tasks have written their files when another fails.
    rows = spark.range(1000, numPartitions=4).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error("stop").cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        publish_archive(rows, archive, DAY)
    assert spark.read.parquet(archive_path(archive, DAY)).count() == 100
    publish_archive(spark.range(7), archive, DAY)
    Path(f"{archive}/weekly_summary={DAY}").joinpath("part-x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        publish_current(spark, archive, DAY, result)
    assert spark.read.parquet(current).count() == 100
    assert [p.name for p in Path(result).iterdir()] == ["weekly_summary"]
    assert [p.name for p in Path(archive).iterdir()] == [f"weekly_summary={DAY}"]


def test_an_upsert_that_fails_half_way_leaves_the_old_batch(spark, tmp_path):
    path = str(tmp_path / "items")
    items = spark.createDataFrame([("2020", f"2020-01-{d:02}", {"a": "1"}) for d in range(1, 9)], "year string, date string, attributes map<string,string>")
    upsert_items(items, path, 0)
    broken = items.withColumn("date", F.when(F.col("date") < "2020-01-08", F.col("date")).otherwise(F.raise_error("stop").cast("string")))
    with pytest.raises(Exception, match="stop"):
        upsert_items(broken.repartition(4), path, 0)
    assert read_items(spark, path).count() == 8
    upsert_items(items.limit(3), path, 0)
    assert read_items(spark, path).count() == 3


def test_copies_have_the_bytes_of_their_source(spark, tmp_path):
    """Encodings, line ends, no line end at all, an empty file, odd names, a file of many blocks."""
    base, archive, result = tmp_path / "in", tmp_path / "the archive", tmp_path / "result"
    land(base)
    odd = {
        "store": "k,v\r\n1,\"say \"\"hi\"\"\"\r\n2,Zürich".encode("latin-1"),
        "calendar": "﻿k;v\n\n".encode("utf-16"),
        "product": bytes(range(256)) * 5000,
    }
    for name, content in odd.items():
        (base / f"{name}_{DAY}.csv").write_bytes(content)
    assert run_gate(spark, str(base), str(archive), str(result), DAY) == []
    for name, content in odd.items():
        assert (archive / f"{name}_{DAY}.csv").read_bytes() == content
        assert (result / f"{name}.csv").read_bytes() == content
    assert not list(result.glob(".*")) + list(archive.glob(".*"))


def test_copies_of_folders_replace_what_was_there(spark, tmp_path):
    plain, target = tmp_path / "plain one", tmp_path / "out" / "copy"
    plain.mkdir()
    target.mkdir(parents=True)
    (target / "stale.csv").write_text("old")
    for f in ("x,1 %20.csv", "y.csv", "_SUCCESS"):
        (plain / f).write_bytes(f.encode() + b"\xff\x00")
    report = {Path(r.target).name: r for r in copies.copy_files(spark, {str(target): str(plain)}).collect()}
    assert {p.name for p in target.iterdir()} == set(report) == {"x,1 %20.csv", "y.csv"}
    for name, r in report.items():
        content = (plain / name).read_bytes()
        assert (target / name).read_bytes() == content and r.bytes == len(content)
        assert r.source_sha256 == r.copy_sha256 == hashlib.sha256(content).hexdigest()
        assert Path(r.target.removeprefix("file:")).parent == target
    copies.copy_files(spark, {str(target): str(plain / "y.csv")})  # a file where a folder was
    assert target.read_bytes() == (plain / "y.csv").read_bytes()
    with pytest.raises(FileNotFoundError):
        copies.copy_files(spark, {str(target): str(tmp_path / "nothing")})
    assert target.is_file()


def test_gate_sees_extracts_in_folders(spark, tmp_path):
    base = str(tmp_path / "in")
    for name in REQUIRED_TABLES:
        spark.range(3).selectExpr("id AS k", "'v' AS v").write.option("header", True).csv(f"{base}/{name}_{DAY}.csv")
    assert run_gate(spark, base, str(tmp_path / "a"), str(tmp_path / "r"), DAY) == []
    assert read_landing(spark, str(tmp_path / "a"), "product", DAY).count() == 3
    odd = listing(spark, f"in/sales_{DAY}.csv/_SUCCESS", f"in/store_{DAY}.csv/.part.crc", f"in/store_{DAY}.csv/x/part-0")
    assert landed_files(odd).count() == 0


def test_register_follows_path_and_columns(spark, tmp_path):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    spark.range(2).write.parquet(first)
    spark.range(5).selectExpr("id", "'x' AS more").write.parquet(second)
    assert register_table(spark, "moving", first).count() == 2
    assert register_table(spark, "moving", second).columns == ["id", "more"]
    spark.range(7).selectExpr("'x' AS other").write.mode("overwrite").parquet(second)
    table = register_table(spark, "moving", second)
    assert table.columns == ["other"] and table.count() == 7
    assert spark.read.parquet(first).count() == 2
    spark.sql("DROP TABLE moving")


def test_days_with_added_and_widened_columns_are_one_table(spark, tmp_path):
    archive = str(tmp_path / "days' own")
    days = {
        "2020-01-01": "SELECT 1 AS id, CAST(1.5 AS FLOAT) AS v, CAST(1.25 AS DECIMAL(5,2)) AS p, DATE'2020-01-01' AS d",
        "2020-01-02": "SELECT 5000000000 AS id, 2.5D AS v, CAST(1.125 AS DECIMAL(9,3)) AS p, DATE'2020-01-02' AS d, 'x' AS more",
        "2020-01-03": "SELECT CAST(3 AS SMALLINT) AS id, 7 AS v, 'y' AS more, array(1) AS `odd ``name`",
    }
    for date, sql in days.items():
        publish_archive(spark.sql(sql), archive, date)
        table = register_table(spark, "widening", archive)
    got = {r.id: r for r in table.collect()}
    assert [f.simpleString() for f in table.schema][:3] == ["id:bigint", "v:double", "p:decimal(9,3)"]
    assert set(got) == {1, 5000000000, 3} and [got[i].v for i in (1, 5000000000, 3)] == [1.5, 2.5, 7.0]
    assert got[1].p == Decimal("1.250") and got[1].more is None and got[3].more == "y" and got[3].p is None
    assert got[3]["odd `name"] == [1] and str(got[3].weekly_summary) == "2020-01-03"
    publish_archive(spark.sql("SELECT 'text' AS id"), archive, "2020-01-04")
    with pytest.raises(ValueError, match="column id: no type holds both bigint and string"):
        register_table(spark, "widening", archive)
    spark.sql("DROP TABLE widening")


def test_files_of_other_writers_are_registered(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    pq.write_table(pa.table({"id": pa.array([1], pa.int32())}), folder / "a.parquet")
    pq.write_table(pa.table({"id": pa.array([2], pa.int64()), "t": ["x"]}), folder / "b.parquet")
    rows = register_table(spark, "others", str(folder)).collect()
    assert sorted((r.id, r.t) for r in rows) == [(1, None), (2, "x")]
    spark.sql("DROP TABLE others")
