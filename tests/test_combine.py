"""CSV sets with differing headers, union by name, row numbers."""

import csv
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockglass.operators.combine import SPLIT_KEYS, union_by_name, with_row_index
from stockglass.plans.stations import combine_stations
from stockglass.sources.csv_set import file_layout, read_csv_set
from tests.plans import initial_plan


def put(path, header, *rows):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])


def read_written(folder):
    rows = []
    for part in sorted(Path(folder).glob("*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            header, *body = list(csv.reader(f))
        rows += [dict(zip(header, r)) for r in body]
    return rows


def test_columns_match_by_name(spark, tmp_path):
    put(tmp_path / "1.csv", ["a", "b"], ["1", "2"])
    put(tmp_path / "2.csv", ["b", "a", "c"], ["4", "3", "5"])
    put(tmp_path / "deeper/3.csv", ["a", "b"], ["x", "x"])
    df = read_csv_set(spark, f"{tmp_path}/*.csv")
    assert df.columns == ["a", "b", "c"]
    assert sorted(map(tuple, df.collect())) == [("1", "2", None), ("3", "4", "5")]


def test_headers_are_found_in_small_and_split_files(spark, tmp_path):
    for i in range(12):
        put(tmp_path / f"{i:02}.csv", ["a", "b"] if i % 2 else ["b", "a"], *[["1", "2"]] * (i + 1))
    put(tmp_path / "long.csv", ["z"], *[[str(i)] for i in range(30000)])
    sizes = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(s) for s in sizes]
    try:
        spark.conf.set(sizes[0], "20KB")
        layout = file_layout(spark, f"{tmp_path}/*.csv")
        assert layout.names == ["b", "a", "z"] and layout.width == 2
        places = sorted(str(r[1]) for r in layout.places.collect())
        assert places == ["[0, 1, None]"] * 6 + ["[1, 0, None]"] * 6 + ["[None, None, 0]"]
        assert spark.conf.get(sizes[1]) == before[1]
        assert read_csv_set(spark, f"{tmp_path}/*.csv").count() == sum(range(1, 13)) + 30000
    finally:
        for s, v in zip(sizes, before):
            spark.conf.set(s, v)


def test_missing_texts(spark, tmp_path):
    put(tmp_path / "1.csv", ["a", "b"], ["NA", "0"], ["", "null"], ["na", " "])
    assert sorted(map(str, map(tuple, read_csv_set(spark, f"{tmp_path}/1.csv").collect()))) == sorted(
        map(str, [(None, "0"), (None, None), ("na", " ")])
    )
    kept = read_csv_set(spark, f"{tmp_path}/1.csv", missing=())
    assert {r.a for r in kept.collect()} == {"NA", None, "na"}


def test_odd_names_survive(spark, tmp_path):
    header = ["a.b", "c`d", 'e "f"', "Max Temp (°C)"]
    put(tmp_path / "1.csv", header, ["1", "2", "x, y", '"q"'])
    out = tmp_path / "out"
    assert combine_stations(spark, f"{tmp_path}/*.csv", str(out)) == 1
    assert read_written(out) == [dict(zip(header, ["1", "2", "x, y", '"q"']))]


def test_union_ignores_order_of_parts(spark):
    a = spark.createDataFrame([("1", "2")], "a string, b string")
    b = spark.createDataFrame([("3", "4")], "c string, a string")
    for parts in ([a, b], [b, a]):
        rows = union_by_name(parts).select("a", "b", "c").collect()
        assert sorted(map(str, map(tuple, rows))) == [
            "('1', '2', None)", "('4', None, '3')",
        ]
    with pytest.raises(ValueError):
        union_by_name([])


def test_row_index_follows_path_and_position(spark, tmp_path):
    rng = random.Random(3)
    wanted = []
    for i in range(9):
        header = ["name", "n"] if i % 2 else ["n", "name"]
        rows = [{"name": f"{i}-{j:05}", "n": str(rng.random())} for j in range(rng.choice([1, 50, 900]))]
        put(tmp_path / f"{i}.csv", header, *[[r[h] for h in header] for r in rows])
        wanted += [r["name"] for r in rows]
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "4KB")
        rows = with_row_index(
            read_csv_set(spark, f"{tmp_path}/*.csv", with_split=True), SPLIT_KEYS
        ).collect()
    finally:
        spark.conf.set(size, before)
    assert [r.row_index for r in sorted(rows, key=lambda r: r.row_index)] == list(range(len(wanted)))
    assert [r.name for r in sorted(rows, key=lambda r: r.row_index)] == wanted


def test_places_and_numbers_do_not_depend_on_how_tables_are_joined(spark, tmp_path):
    """Many files, more than one header, every join by a shuffle, splits of some bytes."""
    wanted = []
    for i in range(40):
        header = [["n", "name"], ["name", "n"], ["x", "name", "n"]][i % 3]
        rows = [{"name": f"{i:02}-{j:03}", "n": str(j), "x": "y"} for j in range(i * 7 % 30)]
        put(tmp_path / f"{i:02}.csv", header, *[[r[h] for h in header] for r in rows])
        wanted += [(r["name"], r["n"], "y" if i % 3 == 2 else None) for r in rows]
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "300B",
        "spark.sql.files.openCostInBytes": "10B",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        rows = with_row_index(read_csv_set(spark, f"{tmp_path}/*.csv", with_split=True), SPLIT_KEYS)
        assert rows.columns == ["row_index", "n", "name", "x"]
        got = sorted(rows.select("row_index", "name", "n", "x").collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [tuple(r) for r in got] == [(i, *w) for i, w in enumerate(wanted)]


def test_the_plan_does_not_grow_with_files(spark, tmp_path):
    def plan(files):
        for i in range(files):
            put(tmp_path / str(files) / f"{i:03}.csv", ["a", "b"] if i % 2 else ["b", "a"], ["1", "2"])
        return initial_plan(read_csv_set(spark, f"{tmp_path}/{files}/*.csv"))

    few, many = plan(4), plan(60)
    assert len(few.splitlines()) == len(many.splitlines())
    assert many.count("Scan csv") == few.count("Scan csv") == 1


def test_row_index_without_split_keys(spark):
    df = with_row_index(spark.range(0, 1000, numPartitions=7))
    assert df.where(F.col("row_index") != F.col("id")).count() == 0 and df.count() == 1000


def test_combined_file_has_an_unnamed_index(spark, tmp_path):
    put(tmp_path / "1.csv", ["a"], ["x"], ["y"])
    put(tmp_path / "2.csv", ["a", "b"], ["z", "w"])
    out = tmp_path / "out"
    assert combine_stations(spark, f"{tmp_path}/*.csv", str(out), row_index=True) == 3
    rows = sorted(read_written(out), key=lambda r: r[""])
    assert rows == [
        {"": "0", "a": "x", "b": ""},
        {"": "1", "a": "y", "b": ""},
        {"": "2", "a": "z", "b": "w"},
    ]


def test_no_input(spark, tmp_path):
    out = tmp_path / "out"
    assert combine_stations(spark, f"{tmp_path}/*.csv", str(out)) == 0
    assert not out.exists()
    with pytest.raises(FileNotFoundError):
        combine_stations(spark, f"{tmp_path}/*.csv", str(out), row_index=True)


def test_any_file_name_and_line_breaks(spark, tmp_path):
    for name, row in (("a b%20.csv", '1,"x\ny"'), ("c[1]{z}*.csv", '2,"p, q"')):
        (tmp_path / name).write_text(f"k,v\n{row}\n")
    rows = read_csv_set(spark, f"{tmp_path}/*.csv", multi_line=True)
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "x\ny"), ("2", "p, q")]


def test_header_pass_leaves_the_session_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n1\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    read_csv_set(spark, f"{tmp_path}/*.csv").collect()
    assert before == {k: spark.conf.get(k) for k in before}
