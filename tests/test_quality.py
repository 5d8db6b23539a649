import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stockglass.operators import quality as dq
from tests.plans import initial_plan


def one(df):
    (row,) = df.collect()
    return row


def column(spark, values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_nulls_are_missing_not_unexpected(spark):
    df = column(spark, [None, 7, 1])
    for e in (dq.in_set("v", [0, 1]), dq.between("v", 0, 1)):
        row = one(dq.run_expectation(df, e))
        assert (row.element_count, row.missing_count, row.unexpected_count) == (3, 1, 1)
        assert not row.success and row.unexpected_percent == 50.0
    row = one(dq.run_expectation(df, dq.not_null("v")))
    assert (row.missing_count, row.unexpected_count) == (0, 1)


def test_bounds_are_inclusive_and_may_be_open(spark):
    df = column(spark, [0, 1, 5])
    assert one(dq.run_expectation(df, dq.between("v", 0, 5))).success
    assert one(dq.run_expectation(df, dq.between("v", 1))).unexpected_count == 1
    assert one(dq.run_expectation(df, dq.between("v", high=4))).unexpected_count == 1
    with pytest.raises(ValueError):
        dq.between("v")


def test_every_row_of_a_repeated_value_is_unexpected(spark):
    row = one(dq.run_expectation(column(spark, [1, 1, 1, 2, None, None]), dq.unique("v")))
    assert (row.element_count, row.missing_count, row.unexpected_count) == (6, 2, 3)


def test_empty_table_passes(spark):
    df = column(spark, [])
    for e in (dq.not_null("v"), dq.in_set("v", [1]), dq.unique("v")):
        row = one(dq.run_expectation(df, e))
        assert row.success and row.element_count == 0 and row.unexpected_percent is None


def test_shipped_suites():
    inventory = {(e.kind, e.column): e for e in dq.INVENTORY_SUITE.expectations}
    sales = {(e.kind, e.column): e for e in dq.SALES_SUITE.expectations}
    assert len(inventory) == 4 and len(sales) == 3
    assert inventory[dq.BETWEEN, "store_key"].high == 9999
    assert sales[dq.BETWEEN, "store_key"].high == 9990
    with pytest.raises(ValueError):
        dq.Suite("twice", (dq.not_null("v"), dq.not_null("v")))


def test_suite_by_name_over_a_catalog_table(spark):
    df = spark.createDataFrame(
        [(1, 100, 0.5), (1, 99, 0.2), (2, 9991, None)], "trans_id int, store_key int, discount double"
    )
    df.createOrReplaceTempView("raw_sales")
    rows = {r.column: r for r in dq.validate("raw_sales", "sales_data_check").collect()}
    assert {c: r.unexpected_count for c, r in rows.items()} == {
        "trans_id": 2,
        "store_key": 2,
        "discount": 0,
    }
    stats = one(dq.suite_summary(dq.validate(df, dq.SALES_SUITE)))
    assert (stats.evaluated_expectations, stats.successful_expectations) == (3, 1)
    assert not stats.success
    assert json.loads(stats.record)["unsuccessful_expectations"] == 2


def test_row_level_expectations_share_one_aggregation(spark):
    df = spark.createDataFrame(
        [(1, 0, 100, 1)], "prod_key int, out_of_stock_flg int, store_key int, inventory_on_hand_qty int"
    )
    plan = initial_plan(dq.run_suite(df, dq.INVENTORY_SUITE))
    assert plan.count("Exchange") == 1 and "Union" not in plan


def test_sample_is_bounded_and_ordered_sample_is_stable(spark):
    df = spark.range(5000)
    assert dq.sample_rows(df).count() == 1000
    pick = lambda d: {r.id for r in dq.sample_rows(d, 50, F.md5(F.col("id").cast("string"))).collect()}
    assert pick(df) == pick(df.repartition(7)) and len(pick(df)) == 50


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=30))
def test_counts_match_a_plain_count(spark, values):
    suite = dq.Suite("s", (dq.not_null("v"), dq.in_set("v", [0, 1]), dq.between("v", -1, 2), dq.unique("v")))
    got = [r.unexpected_count for r in dq.run_suite(column(spark, values), suite).orderBy("position").collect()]
    given_values = [v for v in values if v is not None]
    assert got == [
        len(values) - len(given_values),
        sum(v not in (0, 1) for v in given_values),
        sum(not -1 <= v <= 2 for v in given_values),
        sum(given_values.count(v) > 1 for v in given_values),
    ]


def test_a_suite_scans_its_table_once(spark, tmp_path):
    """Two unique columns and row-level expectations: counts by hand, one scan, one exchange of values."""
    values = [(1, "a", 5), (1, "b", None), (2, "b", 7), (None, "c", 8), (3, None, 9), (3, None, -1), (3, "d", 5)]
    spark.createDataFrame(values, "k int, t string, q int").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    suite = dq.Suite("s", (dq.between("q", 0, 8), dq.unique("k"), dq.not_null("t"), dq.unique("t"), dq.in_set("k", [1, 2])))
    result = dq.run_suite(rows, suite)
    got = [(r.position, r.element_count, r.missing_count, r.unexpected_count) for r in result.orderBy("position").collect()]
    assert got == [(0, 7, 1, 2), (1, 7, 1, 5), (2, 7, 0, 2), (3, 7, 2, 2), (4, 7, 1, 3)]
    plan = initial_plan(result)
    assert plan.count("FileScan") == 1 and plan.count("Union") == 0
    assert plan.count("FileScan") == initial_plan(dq.run_suite(rows, dq.Suite("u", (dq.unique("k"),)))).count("FileScan")
