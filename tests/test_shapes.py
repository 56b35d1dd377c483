"""Physical plans that must hold at scale: scans, shuffles and pushed filters."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from workloads import QUERIES
from tidemark.operators import checks, neighbours, reshape, suite
from tidemark.operators.copies import repeat_rows
from tidemark.sources import landing
from workloads.inputs import table

SF_DIR = "/root/testdata/sf0.001"
# Queries whose plans join a single row, or a series made from a handful of bounds.
BOUNDED_LOOPS = set()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, operator):
    return len(re.findall(rf"(?m)^[\s:+\-|]*{operator}", text))


@pytest.fixture
def lines(spark):
    return table(spark, SF_DIR, "lineitem")


def test_comparing_two_tables_takes_one_shuffle(lines):
    urgent, other = lines.filter("l_returnflag = 'A'"), lines.filter("l_returnflag = 'R'")
    for df in (
        checks.equality(urgent, other, compare_columns=["l_partkey", "l_tax"]),
        checks.equal_rowcount(urgent, other, ["l_partkey"]),
        checks.cardinality_equality(urgent, "l_partkey", other, "l_suppkey"),
    ):
        shape = plan(df)
        assert count(shape, "Exchange") == 1 and "Join" not in shape


def test_unpivot_and_row_checks_scan_once(lines):
    assert count(plan(reshape.unpivot(lines, exclude=["l_orderkey"], remove=["l_shipdate"])), "FileScan") == 1
    report = suite.run_row_checks(
        lines, [suite.RowCheck("a", checks.is_missing("l_tax")), suite.RowCheck("b", checks.is_out_of_range("l_quantity", 1, 50))]
    )
    shape = plan(report)
    assert count(shape, "FileScan") == 1 and "l_comment" not in shape and "l_shipdate" not in shape


def test_filters_and_columns_reach_the_scan(lines):
    shape = plan(checks.accepted_range(lines, "l_quantity", 0, 60, where="l_partkey > 10").select("l_orderkey"))
    assert "GreaterThan(l_partkey,10)" in shape and "l_shipdate" not in shape


def test_relationship_check_joins_distinct_values(spark, lines):
    shape = plan(checks.relationships_where(lines, "l_partkey", table(spark, SF_DIR, "part"), "p_partkey"))
    assert shape.index("LeftAnti") < shape.index("partial_count")


def test_no_query_runs_python_per_row_or_a_cross_join(spark):
    for name, function in QUERIES.items():
        shape = plan(function(spark, SF_DIR))
        assert "Python" not in shape and "CartesianProduct" not in shape, name
        assert "NestedLoop" not in shape or name in BOUNDED_LOOPS, name


def test_choosing_a_source_by_key_takes_one_join(lines):
    candidates = [lines.filter(F.col("l_returnflag") == flag).select("l_partkey", "l_tax") for flag in "ANR"]
    shape = plan(landing.first_nonempty(candidates, by=["l_partkey"]))
    assert count(shape, "(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)") == 1 and count(shape, "Union") == 2


def test_neighbours_write_once_and_read_twice(spark, lines):
    shape = plan(neighbours.add_neighbour(lines.select("l_orderkey", "l_tax"), "near", ["l_tax"], ["l_orderkey"]))
    assert count(shape, "FileScan") == 2 and shape.count("PushedFilters: [IsNotNull(__edge), EqualTo(__edge,true)") == 1


def test_single_copies_are_not_shuffled(spark):
    df = spark.range(10).selectExpr("id", "id AS n")
    shape = plan(repeat_rows(df, "n"))
    assert count(shape, "Exchange") == 1  # of the counts beyond one block


def test_distinct_pivots_do_not_copy_the_table(spark, lines):
    shape = plan(reshape.pivot(lines, ["l_suppkey"], "l_returnflag", ["A", "N", "R"], agg="count", then_value="l_tax", else_value="null", distinct=True))
    assert "Expand" not in shape


def test_row_checks_of_a_suite_share_a_scan(lines):
    shape = plan(suite.run_suite([suite.RowCheck("a", checks.is_missing("l_tax"), table=lines), suite.RowCheck("b", checks.is_missing("l_partkey"), table=lines)]))
    assert count(shape, "FileScan") == 1
