"""Every check with a table that passes and one that fails."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, suite


def failing(df):
    return df.count()


def test_not_null(table, rows):
    df = table("a int, b int", (1, 1), (2, None))
    assert failing(checks.not_null(df, "a")) == 0
    assert rows(checks.not_null(df, "b")) == [(2, None)]
    assert failing(checks.not_null(df, "b", where="a = 1")) == 0


def test_unique(table, rows):
    df = table("a int, b int", (1, 1), (2, 1), (3, None), (4, None))
    assert failing(checks.unique(df, "a")) == 0
    assert rows(checks.unique(df, "b")) == [(1, 2)]


def test_accepted_values(table, rows):
    df = table("t string", ("up",), ("down",), ("down",), (None,))
    assert failing(checks.accepted_values(df, "t", ["up", "down"])) == 0
    assert rows(checks.accepted_values(df, "t", ["up"])) == [("down", 2)]


def test_not_accepted_values(table, rows):
    df = table("city string", ("Rome",), ("Rome",), ("Madrid",))
    assert failing(checks.not_accepted_values(df, "city", ["Berlin"])) == 0
    assert rows(checks.not_accepted_values(df, "city", ["Rome", "Berlin"])) == [("Rome",)]


@pytest.mark.parametrize(
    "options, bad",
    [
        ({"min_value": -1, "max_value": 11}, 0),
        ({"min_value": -2, "max_value": 11.1, "inclusive": False}, 0),
        ({"min_value": 0}, 1),
        ({"min_value": 0, "where": "id <> -1"}, 0),
        ({"max_value": 11, "inclusive": False}, 1),
        ({"max_value": "high"}, 1),
        ({}, 0),
    ],
)
def test_accepted_range(table, options, bad):
    df = table("id int, high int", (-1, 0), (11, 10), (None, 5))
    assert failing(checks.accepted_range(df, "id", **options)) == bad


def test_at_least_one(table, rows):
    df = table("g string, v int", ("a", 1), ("a", None), ("b", None))
    assert failing(checks.at_least_one(df, "v")) == 0
    assert rows(checks.at_least_one(df, "v", where="g = 'b'")) == [(0,)]
    assert rows(checks.at_least_one(df, "v", ["g"])) == [("b", 0)]


def test_not_constant(table, rows):
    df = table("g string, v int, n int", ("a", 1, None), ("a", 2, None), ("b", 3, None))
    assert failing(checks.not_constant(df, "v")) == 0
    assert rows(checks.not_constant(df, "v", ["g"])) == [("b", 1)]
    assert failing(checks.not_constant(df, "n")) == 0
    assert rows(checks.not_constant(df, "v", where="g = 'b'")) == [(1,)]
    assert failing(checks.not_constant(df, "g")) == 0
    assert rows(checks.not_constant(df, "g", ["v"])) == [(1, 1), (2, 1), (3, 1)]
    assert failing(checks.not_constant(df.withColumn("t", F.col("n").cast("string")), "t")) == 0


def test_not_null_proportion(table, rows):
    df = table("g string, half int, most int", *[("a" if i < 5 else "b", i if i % 2 else None, i if i else None) for i in range(10)])
    assert failing(checks.not_null_proportion(df, "half", 0.5, 0.5)) == 0
    assert failing(checks.not_null_proportion(df, "half", 0, 0.4)) == 1
    assert failing(checks.not_null_proportion(df, "most", 0.9)) == 0
    assert rows(checks.not_null_proportion(df, "most", 0.9, group_by=["g"])) == [("a", 0.8)]
    assert failing(checks.not_null_proportion(df, "half", 0.9, where="false")) == 0


def test_expression_is_true(table):
    df = table("a double, b double", (0.5, 0.5), (0.0, 1.0), (None, 1.0))
    assert failing(checks.expression_is_true(df, "a + b = 1")) == 0
    assert failing(checks.expression_is_true(df, "= 0.5", column="a")) == 1
    assert failing(checks.expression_is_true(df, "= 0.5", column="a", where="b = 0.5")) == 0
    assert failing(checks.expression_is_true(df, F.col("a") > 0)) == 1


def test_not_empty_string(table):
    df = table("id int, t string", (1, "a"), (2, "a  "), (3, "  "), (4, ""), (5, None))
    assert failing(checks.not_empty_string(df, "t")) == 2
    assert failing(checks.not_empty_string(df, "t", trim_whitespace=False)) == 1
    assert failing(checks.not_empty_string(df, "t", where="id < 3")) == 0


def test_assert_equal(table):
    df = table("a int, b int", (1, 1), (None, 2))
    assert failing(checks.assert_equal(df, "a", "b")) == 0
    assert failing(checks.assert_equal(df, "a", "b", null_safe=True)) == 1
    assert failing(checks.assert_equal(df, "a", F.lit(2))) == 1


def test_unique_combination(table, rows):
    df = table("m string, p string", ("jan", "x"), ("jan", "y"), ("feb", None), ("feb", None))
    assert failing(checks.unique_combination_of_columns(df, ["m", "p"], where="m = 'jan'")) == 0
    assert rows(checks.unique_combination_of_columns(df, ["m", "p"])) == [("feb", None)]


@pytest.mark.parametrize(
    "options, bad",
    [
        ({"interval": 24}, 0),
        ({"interval": 22}, 1),
        ({"interval": 0}, 1),
        ({"interval": 0, "ignore_time_component": True}, 1),
        ({"interval": 1, "datepart": "day", "ignore_time_component": True}, 0),
    ],
)
def test_recency(table, options, bad):
    df = table("g int, t timestamp_ntz", (1, dt.datetime(2020, 5, 1, 13, 0)), (1, dt.datetime(2020, 1, 1)))
    options = {"datepart": "hour", **options}
    assert failing(checks.recency(df, "t", as_of="2020-05-02 12:00:00", **options)) == bad
    assert failing(checks.recency(df, "t", as_of="2020-05-02 12:00:00", group_by=["g"], **options)) == bad


def test_recency_against_now(spark):
    fresh = spark.range(1).select((F.current_timestamp() - F.expr("interval 23 hours")).alias("t"))
    assert failing(checks.recency(fresh, "t", "day", 1)) == 0
    assert failing(checks.recency(fresh, "t", "hour", 22)) == 1


# --- row order ---

def test_sequential_values(table, rows):
    even = table("g string, n int", *[("a", i) for i in range(0, 20, 2)], *[("b", i) for i in (1, 3, 3, 3, 9)])
    assert failing(checks.sequential_values(even, "n", 2, where="g = 'a'")) == 0
    bad = checks.sequential_values(even, "n", 2, group_by=["g"])
    assert bad.columns == ["g", "n", "previous_n"]
    assert rows(bad) == [("b", 3, 3), ("b", 3, 3), ("b", 9, 3)]


def test_sequential_timestamps(table, rows):
    hours = [dt.datetime(2021, 1, 1, hour) for hour in (0, 1, 2, 4)]
    df = table("t timestamp_ntz", *[(hour,) for hour in hours])
    assert rows(checks.sequential_values(df, "t", 1, "hour")) == [(hours[3], hours[2])]
    assert failing(checks.sequential_values(df, "t", 1, "hour", where="hour(t) < 3")) == 0


@pytest.mark.parametrize(
    "ranges, options, bad",
    [
        ([(0, 1), (1, 3), (3, 9)], {"gaps": "not_allowed"}, 0),
        ([(0, 1), (2, 3)], {"gaps": "not_allowed"}, 1),
        ([(0, 1), (2, 3)], {"gaps": "allowed"}, 0),
        ([(0, 2), (1, 3)], {"gaps": "allowed"}, 1),
        ([(0, 1), (2, 3)], {"gaps": "required"}, 0),
        ([(0, 1), (1, 3)], {"gaps": "required"}, 1),
        ([(0, 0), (1, 3)], {}, 1),
        ([(0, 0), (1, 3)], {"zero_length_range_allowed": True}, 0),
        ([(0, 5), (0, 5), (0, 5), (5, 6)], {}, 2),
        ([(0, None)], {}, 1),
        ([(0, 1), (None, 3)], {}, 1),
    ],
)
def test_mutually_exclusive_ranges(table, ranges, options, bad):
    df = table("a int, b int", *ranges)
    assert failing(checks.mutually_exclusive_ranges(df, "a", "b", **options)) == bad


def test_open_ranges_by_group(table, rows):
    df = table("s int, a int, b int", (1, 0, 4), (1, 4, None), (2, 1, 2), (2, 1, 3))
    bad = checks.mutually_exclusive_ranges(df, "a", "coalesce(b, 99)", partition_by="s")
    assert rows(bad.select("partition_by_col", "lower_bound", "upper_bound", "next_lower_bound", "is_last_record")) == [(2, 1, 2, 1, False)]
    assert bad.columns[-1] == "upper_bound_less_than_or_equal_to_next_lower_bound"


def test_ranges_by_definition_on_random_data(spark, rows):
    """One group holds most rows; there are ties and missing bounds on both sides."""
    pick = random.Random(11)
    bound = lambda: pick.choice([None, *[pick.randrange(12) for _ in range(7)]])
    data = [("hot" if pick.random() < 0.6 else pick.choice("abc"), bound(), bound()) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, a int, b int")
    wanted = []
    for group in {g for g, _, _ in data}:
        members = sorted((row for row in data if row[0] == group), key=lambda r: [(x is None, x or 0) for x in r[1:]])
        top = max(range(len(members)), key=lambda i: ([(x is not None, x or 0) for x in members[i][1:]], i))
        for i, (_, low, high) in enumerate(members):
            following = members[i + 1][1] if i + 1 < len(members) else None
            length = low is not None and high is not None and low < high
            gap = high <= following if high is not None and following is not None else i == top
            if not (length and gap):
                wanted.append((group, low, high, following, i == top, length, gap))
    bad = checks.mutually_exclusive_ranges(df, "a", "b", ["g"])
    assert rows(bad) == sorted(wanted, key=lambda row: [(value is not None, str(value)) for value in row])


def test_last_flag_with_a_missing_upper_bound(table, rows):
    bad = checks.mutually_exclusive_ranges(table("a int, b int", (5, 9), (5, None)), "a", "b")
    assert rows(bad.select("lower_bound", "upper_bound", "is_last_record")) == [(5, None, False), (5, 9, True)]


def test_unknown_gap_rule(table):
    with pytest.raises(ValueError):
        checks.mutually_exclusive_ranges(table("a int, b int", (1, 2)), "a", "b", gaps="some")


# --- two tables ---


def test_relationships_where(table, rows):
    child = table("id int, kind string", (1, "x"), (4, "y"), (4, "y"), (None, "x"))
    parent = table("key int", (1,), (1,), (None,))
    assert rows(checks.relationships_where(child, "id", parent, "key")) == [(4, None), (4, None)]
    assert failing(checks.relationships_where(child, "id", parent, "key", from_condition="id <> 4")) == 0
    assert failing(checks.relationships_where(child, "id", parent, "key", to_condition="key > 1")) == 3


def test_cardinality_equality(table, rows):
    a = table("v string", ("x",), ("x",), ("y",), (None,))
    b = table("w string", ("y",), ("x",), ("x",), (None,))
    c = table("w string", ("x",), ("z",), ("y",))
    assert failing(checks.cardinality_equality(a, "v", b, "w")) == 0
    assert rows(checks.cardinality_equality(a, "v", c, "w")) == [(None, 1), ("x", 1), ("x", 2), ("z", 1)]


def test_equal_rowcount(table, rows):
    a = table("g string", ("x",), ("x",), ("y",), (None,))
    b = table("g string", ("x",), ("y",), ("z",), (None,))
    assert failing(checks.equal_rowcount(a, b)) == 0
    assert rows(checks.equal_rowcount(a, b, where="g = 'x'")) == [(2, 4, 2)]
    assert rows(checks.equal_rowcount(a, b, ["g"])) == [("x", 2, 1, 1), ("z", 0, 1, 1)]
    assert rows(checks.equal_rowcount(a, b, ["g"], strict=False)) == [("x", 2, 1, 1)]


def test_fewer_rows_than(table, rows):
    a = table("g string", ("x",), ("y",), ("n",))
    b = table("g string", ("x",), ("x",), ("y",), ("z",))
    assert failing(checks.fewer_rows_than(a, b)) == 0
    assert rows(checks.fewer_rows_than(b, a)) == [(4, 3, 1)]
    assert rows(checks.fewer_rows_than(a, b, ["g"])) == [("n", 1, 0, 1), ("y", 1, 1, 1)]
    assert rows(checks.fewer_rows_than(a, b, ["g"], strict=False)) == [("y", 1, 1, 1)]
    assert rows(checks.fewer_rows_than(a, a)) == [(3, 3, 1)]


def test_equality(table, rows):
    a = table("col_a int, col_b int, col_c int", (1, 1, 3), (1, 1, 3), (None, 2, 4))
    b = table("col_c int, col_a int, col_b int", (3, 1, 1), (5, None, 2))
    assert failing(checks.equality(a, b, exclude_columns=["COL_C"])) == 0
    assert failing(checks.equality(a, b, compare_columns=["col_a", "col_b"])) == 0
    assert rows(checks.equality(a, b)) == [("a_minus_b", None, 2, 4), ("b_minus_a", None, 2, 5)]
    assert failing(checks.equality(a, b, exclude_columns=["col_c"], multiset=True)) == 1


@pytest.mark.parametrize("multiset", [False, True])
def test_equality_by_digests(spark, rows, multiset):
    """The same failing rows as without digests, with nulls that change places, repeats and rows on one side."""
    data = [(None if i % 7 == 0 else i, None if i % 5 == 0 else i % 11, f"t{i % 3}") for i in range(300)] + [(1, 2, "x")] * 3
    other = data[:40] + [(None, 3, "y"), (2, 2, "x")] + data[41:] + [(1, 2, "x")]
    schema = "a int, b int, `c.d` string"
    left, right = spark.createDataFrame(data + [(3, None, "y")], schema), spark.createDataFrame(other, schema)
    found = rows(checks.equality(left, right, multiset=multiset, digests=True))
    assert found == rows(checks.equality(left, right, multiset=multiset)) and found
    assert checks.equality(left, left.orderBy("b"), multiset=multiset, digests=True).isEmpty()
    assert not checks.equality(spark.createDataFrame([(None, 1)], "a int, b int"), spark.createDataFrame([(1, None)], "a int, b int"), digests=True).isEmpty()


def test_equal_tables_shuffle_digests_only(spark, tmp_path):
    """Nothing but a number per part and task crosses the network: the plan that ran has no other exchange."""
    path = str(tmp_path / "rows")
    spark.range(20_000).selectExpr("id", "id % 97 AS v", "concat('t', id) AS t").write.parquet(path)
    same = checks.equality(spark.read.parquet(path), spark.read.parquet(path).orderBy("v").select("id", "v", "t"), digests=True)
    assert same.collect() == []
    plan = same._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "LocalTableScan" in final or "EmptyRelation" in final or "Scan parquet" not in final


def test_equality_with_precision(table):
    a = table("id int, x double, d decimal(10,8)", (1, 0.123451, Decimal(1)))
    b = table("id int, x double, d decimal(10,8)", (1, 0.123452, Decimal(1)))
    assert failing(checks.equality(a, b, precision=4)) == 0
    assert failing(checks.equality(a, b, precision=8)) == 2


def test_equality_refuses_unequal_columns(table):
    a, b = table("a int, b int", (1, 1)), table("a int", (1,))
    with pytest.raises(ValueError):
        checks.equality(a, b)
    with pytest.raises(ValueError):
        checks.equality(a, b, compare_columns=["a"], exclude_columns=["b"])
    assert failing(checks.equality(a, b, exclude_columns=["b"])) == 0


def test_columns_match_set(table, rows):
    df = table("id int, name string", (1, "a"))
    assert failing(checks.columns_match_set(df, ["ID", "name"])) == 0
    assert rows(checks.columns_match_set(df, ["id", "color"])) == [(None, "name"), ("color", None)]


# --- reports ---


def test_statuses(table):
    df = table("v int", (1,), (None,), (None,))
    bad = checks.not_null(df, "v")
    for (severity, warn_if, error_if), status in {
        ("error", "!= 0", "!= 0"): "fail",
        ("error", "!= 0", "> 2"): "warn",
        ("error", "> 2", "> 2"): "pass",
        ("warn", "!= 0", "!= 0"): "warn",
        ("error", "!= 0", "< 1"): "warn",
    }.items():
        report = suite.run_suite([suite.Check("c", bad, thresholds=suite.Thresholds(severity, warn_if, error_if))])
        assert tuple(report.first()) == ("c", 2, status)


def test_weights(table):
    a, b = table("v int", *[(i,) for i in range(5)]), table("v int", (0,), (9,))
    report = suite.run_suite(
        [
            suite.Check("equality", checks.equality(a, b), suite.surplus_weight()),
            suite.Check("rows", checks.equal_rowcount(a, b), suite.sum_weight("diff_count")),
            suite.Check("same", checks.equal_rowcount(a, a), suite.sum_weight("diff_count")),
        ]
    )
    assert [tuple(row) for row in report.collect()] == [("equality", 8, "fail"), ("rows", 3, "fail"), ("same", 0, "pass")]


def test_row_checks_share_one_scan(table):
    df = table("a int, t string", (1, ""), (None, "x"), (70, None))
    report = suite.run_row_checks(
        df,
        [
            suite.RowCheck("present", checks.is_missing("a")),
            suite.RowCheck("in_range", checks.is_out_of_range("a", 0, 50)),
            suite.RowCheck("filled", checks.is_blank("t"), where="a > 1"),
            suite.RowCheck("small", checks.is_untrue("a < 50"), thresholds=suite.Thresholds("warn")),
        ],
    )
    assert [tuple(row) for row in report.collect()] == [("present", 1, "fail"), ("in_range", 1, "fail"), ("filled", 0, "pass"), ("small", 1, "warn")]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


@pytest.mark.parametrize("bad", [{"severity": "bad"}, {"warn_if": "1; drop"}, {"error_if": "many"}])
def test_thresholds_refuse(bad):
    with pytest.raises(ValueError):
        suite.Thresholds(**bad)


def test_empty_suites_are_refused(table):
    for run in (lambda: suite.run_suite([]), lambda: suite.run_row_checks(table("a int", (1,)), [])):
        with pytest.raises(ValueError):
            run()
