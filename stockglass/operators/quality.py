"""Column expectations and the suites made of them.

A suite is a plain constant. Running it gives one row per expectation. The table is
scanned once: expectations that look at one row at a time are counted in the same
aggregation that counts the rows of each value for the uniqueness expectations.

Nulls are left out of judgement (``missing_count``), except by ``not_null``,
which judges them. Bounds are inclusive. Every remaining value has to pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    values: tuple[Any, ...] = ()
    low: Any = None
    high: Any = None
    note: str = ""


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: tuple[Expectation, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        pairs = [(e.kind, e.column) for e in self.expectations]
        if len(set(pairs)) < len(pairs):
            raise ValueError(f"suite {self.name} states an expectation twice")


def not_null(column: str, note: str = "") -> Expectation:
    return Expectation(NOT_NULL, column, note=note)


def in_set(column: str, values: Sequence[Any], note: str = "") -> Expectation:
    return Expectation(IN_SET, column, values=tuple(values), note=note)


def between(column: str, low: Any = None, high: Any = None, note: str = "") -> Expectation:
    """Inclusive; a bound left out does not bind."""
    if low is None and high is None:
        raise ValueError("between needs at least one bound")
    return Expectation(BETWEEN, column, low=low, high=high, note=note)


def unique(column: str, note: str = "") -> Expectation:
    return Expectation(UNIQUE, column, note=note)


# The suites as shipped: fixed names, columns, sets and bounds. The two upper
# bounds of store_key differ, and both are kept.
INVENTORY_SUITE = Suite(
    "input_data_snowflake_check",
    (
        not_null("prod_key"),
        in_set("out_of_stock_flg", (0, 1), "the flag is 0 or 1"),
        between("store_key", 100, 9999, "store numbers have three or four digits"),
        between("inventory_on_hand_qty", 0, 999999, "stock is not negative"),
    ),
)
SALES_SUITE = Suite(
    "sales_data_check",
    (
        unique("trans_id"),
        between("store_key", 100, 9990, "store numbers have three or four digits"),
        between("discount", 0, 1, "the discount is a share"),
    ),
)
SUITES = {suite.name: suite for suite in (INVENTORY_SUITE, SALES_SUITE)}


def _unexpected(e: Expectation) -> Column:
    """True for a value that fails; null (not counted) for a null value."""
    value = F.col(e.column)
    if e.kind == NOT_NULL:
        return value.isNull()
    if e.kind == IN_SET:
        return ~value.isin(*e.values)
    if e.kind == BETWEEN:
        checks = []
        if e.low is not None:
            checks.append(value < F.lit(e.low))
        if e.high is not None:
            checks.append(value > F.lit(e.high))
        return reduce(lambda a, b: a | b, checks)
    raise ValueError(f"no row-level form of {e.kind}")


def _record(position: int, e: Expectation, elements: Column, missing: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(e.kind).alias("expectation_type"),
        F.lit(e.column).alias("column"),
        elements.alias("element_count"),
        missing.alias("missing_count"),
        bad.alias("unexpected_count"),
    )


def _counted(df: DataFrame, numbered: list[tuple[int, Expectation]]) -> DataFrame:
    """One row: elements, missing and unexpected values of every expectation.

    Without uniqueness that is one aggregation. Else rows are first grouped by value,
    once for each unique column (as grouping sets of one scan), combined before the
    shuffle, and the groups of the first column bring the counts of all rows along.
    """
    by_value = [(i, e) for i, e in numbered if e.kind == UNIQUE]
    by_row = [(i, e) for i, e in numbered if e.kind != UNIQUE]
    flags = {f"bad_{i}": _unexpected(e) for i, e in by_row}
    flags |= {f"missing_{i}": F.col(e.column).isNull() for i, e in by_row if e.kind != NOT_NULL}
    values = {f"value_{i}": F.col(e.column) for i, e in by_value}
    rows = df.select(*[c.alias(n) for n, c in (flags | values).items()])
    counts = [F.count(F.lit(1)).alias("elements"), *[F.count_if(F.col(n)).alias(n) for n in flags]]
    if not by_value:
        return rows.agg(*counts)
    sets = [[F.col(n)] for n in values]
    groups = rows.groupingSets(sets, *values).agg(F.grouping_id().alias("set"), *counts)
    # A set's bits say which columns it leaves out; the first column has the highest bit.
    all_out = (1 << len(values)) - 1
    of_set = {n: F.col("set") == all_out - (1 << (len(values) - 1 - j)) for j, n in enumerate(values)}
    first = next(iter(of_set.values()))

    def total(count: str, condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(count))), F.lit(0)).alias(name)

    totals = [total(n, first, n) for n in ("elements", *flags)]
    for i, _ in by_value:
        mine, value = of_set[f"value_{i}"], F.col(f"value_{i}")
        # Every row of a value that occurs more than once is unexpected.
        repeated = mine & value.isNotNull() & (F.col("elements") > 1)
        totals += [
            total("elements", mine & value.isNull(), f"missing_{i}"),
            total("elements", repeated, f"bad_{i}"),
        ]
    return groups.agg(*totals)


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """One result row per expectation, in the order of ``position``. Lazy, like any DataFrame."""
    if not suite.expectations:
        raise ValueError(f"suite {suite.name} has no expectations")
    numbered = list(enumerate(suite.expectations))
    none = F.lit(0).cast("bigint")
    records = [
        _record(i, e, F.col("elements"), none if e.kind == NOT_NULL else F.col(f"missing_{i}"), F.col(f"bad_{i}"))
        for i, e in numbered
    ]
    results = _counted(df, numbered).select(F.inline(F.array(*records)))
    bad, judged = F.col("unexpected_count"), F.col("element_count") - F.col("missing_count")
    return results.select(
        F.lit(suite.name).alias("suite"),
        "position",
        "expectation_type",
        "column",
        (bad == 0).alias("success"),
        "element_count",
        "missing_count",
        "unexpected_count",
        F.try_divide(bad.cast("double") * F.lit(100.0), judged).alias("unexpected_percent"),
    )


def run_expectation(df: DataFrame, expectation: Expectation) -> DataFrame:
    return run_suite(df, Suite("single", (expectation,))).drop("suite", "position")


def validate(
    source: DataFrame | str, suite: Suite | str, spark: SparkSession | None = None
) -> DataFrame:
    """Runs a suite, given or by name, over a DataFrame or a catalog table."""
    if isinstance(suite, str):
        suite = SUITES[suite]
    if isinstance(source, str):
        source = (spark or SparkSession.active()).table(source)
    return run_suite(source, suite)


def suite_summary(results: DataFrame) -> DataFrame:
    """Statistics per suite and the verdict as a JSON record. Nothing is raised on failure."""
    passed = F.count_if(F.col("success"))
    total = F.count(F.lit(1))
    stats = results.groupBy("suite").agg(
        total.alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        (passed.cast("double") * F.lit(100.0) / total).alias("success_percent"),
        F.bool_and("success").alias("success"),
    )
    return stats.withColumn(
        "record",
        F.to_json(
            F.struct(
                "suite",
                "success",
                "evaluated_expectations",
                "successful_expectations",
                "unsuccessful_expectations",
            )
        ),
    )


def sample_rows(df: DataFrame, rows: int = 1000, order_by: Column | None = None) -> DataFrame:
    """At most ``rows`` rows, to try a suite on. Any rows, unless an order is given.

    With an order Spark keeps a bounded heap per partition and merges those.
    """
    return (df if order_by is None else df.orderBy(order_by)).limit(rows)
