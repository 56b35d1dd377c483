"""Data-quality checks. Each returns the failing rows: no rows means that it holds.

``where`` restricts the checked table, not the one it is compared with. Bounds and
conditions are SQL expressions or Columns.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.functions._columns import as_column, as_list, as_predicate
from tidemark.functions.dates import check_unit, shift
from tidemark.functions.keys import slug
from tidemark.operators.compare import COUNT_A, COUNT_B, only_differing, side_counts
from tidemark.operators.copies import repeat_rows
from tidemark.operators.neighbours import counted_rows, distinct_steps
from tidemark.operators.reshape import filtered_columns

# Types that a hash aggregation can hold a minimum and maximum of.
FIXED_WIDTH = (NumericType, DateType, TimestampType, TimestampNTZType)

# How the upper bound of a range must compare with the next lower bound, by kind of gap.
GAP_RULES = {
    "not_allowed": ("equal_to", lambda upper, following: upper == following),
    "allowed": ("less_than_or_equal_to", lambda upper, following: upper <= following),
    "required": ("less_than", lambda upper, following: upper < following),
}


def _rows(df: DataFrame, where) -> DataFrame:
    return df if where is None else df.filter(as_predicate(where))


def _expression(value) -> Column:
    return F.expr(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(value)


# --- row predicates: true for a failing row, so that a suite can test many in one scan ---


def is_missing(column) -> Column:
    return as_column(column).isNull()


def is_out_of_range(column, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    value, outside = as_column(column), F.lit(False)
    if min_value is not None:
        low = _expression(min_value)
        outside = outside | ~(value >= low if inclusive else value > low)
    if max_value is not None:
        high = _expression(max_value)
        outside = outside | ~(value <= high if inclusive else value < high)
    return outside


def is_untrue(expression, column: str | None = None) -> Column:
    return ~as_predicate(f"{column} {expression}" if column else expression)


def is_blank(column, trim_whitespace: bool = True) -> Column:
    value = as_column(column)
    return (F.trim(value) if trim_whitespace else value) == ""


def is_unequal(actual, expected, null_safe: bool = False) -> Column:
    actual, expected = as_column(actual), as_column(expected)
    return ~actual.eqNullSafe(expected) if null_safe else actual != expected


# --- checks on single rows ---


def not_null(df: DataFrame, column, where=None) -> DataFrame:
    return _rows(df, where).filter(is_missing(column))


def accepted_range(df: DataFrame, column, min_value=None, max_value=None, inclusive: bool = True, where=None) -> DataFrame:
    """Rows outside the range; null passes."""
    return _rows(df, where).filter(is_out_of_range(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression, column: str | None = None, where=None) -> DataFrame:
    """Rows for which the expression is false; null passes."""
    return _rows(df, where).filter(is_untrue(expression, column))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True, where=None) -> DataFrame:
    """Empty values of ``column``; null passes."""
    value = as_column(column)
    failing = _rows(df, where).filter(is_blank(column, trim_whitespace))
    return failing.select((F.trim(value) if trim_whitespace else value).alias(column))


def assert_equal(df: DataFrame, actual, expected, null_safe: bool = False, where=None) -> DataFrame:
    return _rows(df, where).filter(is_unequal(actual, expected, null_safe))


# --- checks on values and groups ---


def unique(df: DataFrame, column, where=None) -> DataFrame:
    """Repeated values; nulls are ignored."""
    values = _rows(df, where).select(as_column(column).alias("unique_field")).filter(F.col("unique_field").isNotNull())
    return values.groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def unique_combination_of_columns(df: DataFrame, columns, where=None) -> DataFrame:
    """Repeated combinations; nulls are equal to each other."""
    columns = as_list(columns)
    counted = _rows(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.filter(F.col("__rows") > 1).select(*columns)


def accepted_values(df: DataFrame, column, values, where=None) -> DataFrame:
    """Values outside the list, with their rows; null passes."""
    value = as_column(column)
    outside = _rows(df, where).filter(~value.isin(as_list(values)))
    return outside.groupBy(value.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column, values, where=None) -> DataFrame:
    """Listed values that occur."""
    value = as_column(column)
    return _rows(df, where).filter(value.isin(as_list(values))).select(value.alias("value_field")).distinct()


def at_least_one(df: DataFrame, column, group_by=(), where=None) -> DataFrame:
    """Groups (or the whole table) in which ``column`` is always null."""
    rows, value = _rows(df, where), as_column(column)
    if not group_by:
        # One found value settles it, so each task stops at its first.
        rows = rows.select(value.alias("__value")).filter("__value is not null").limit(1)
        value = F.col("__value")
    counted = rows.groupBy(*group_by).agg(F.count(value).alias("filler_column"))
    return counted.filter("filler_column = 0")


def not_constant(df: DataFrame, column, group_by=(), where=None) -> DataFrame:
    """Groups (or the whole table) with a single distinct value; all-null passes."""
    rows, value = _rows(df, where), as_column(column)
    if isinstance(rows.select(value).schema[0].dataType, FIXED_WIDTH):
        # Equal minimum and maximum say the same, and each task sends one row per group.
        ends = rows.groupBy(*group_by).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
        constant = ends.filter("__low = __high").withColumn("filler_column", F.lit(1).cast("bigint"))
    else:
        # Text cannot be compared in a hash aggregation; distinct pairs can be counted in one.
        constant = rows.groupBy(*group_by).agg(F.count_distinct(value).alias("filler_column")).filter("filler_column = 1")
    return constant.select(*group_by, "filler_column")


def not_null_proportion(df: DataFrame, column, at_least: float, at_most: float = 1, group_by=(), where=None) -> DataFrame:
    """Groups whose share of non-null values is out of bounds; an empty table passes."""
    share = F.try_divide(F.count(as_column(column)), F.count(F.lit(1))).alias("not_null_proportion")
    found = _rows(df, where).groupBy(*group_by).agg(share)
    return found.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by=(),
    as_of: dt.datetime | dt.date | str | None = None,
    where=None,
) -> DataFrame:
    """Groups whose newest ``field`` is older than ``interval`` units before ``as_of`` (now)."""
    kind = "date" if ignore_time_component else "timestamp_ntz"
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    threshold = shift(check_unit(datepart), -interval, now.cast("timestamp_ntz")).cast(kind)
    newest = _rows(df, where).groupBy(*group_by).agg(F.max(as_column(field)).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", threshold).filter(F.col("most_recent") < F.col("threshold"))


# --- checks on row order ---


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by=(),
    where=None,
) -> DataFrame:
    """Rows that do not follow their predecessor by ``interval``; the first row is exempt."""
    group_by = list(group_by)

    def fails(near: Column) -> Column:
        previous = near[column]
        return ~(F.col(column) == (shift(datepart, interval, previous) if datepart else previous + interval))

    counted = counted_rows(_rows(df, where), [*group_by, column])
    failing = distinct_steps(counted, group_by, [column], [column], 1, fails).drop("outer")
    named = failing.withColumn(f"previous_{slug(column)}", F.col("near")[column]).drop("near")
    return repeat_rows(named, "copies")


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound,
    upper_bound,
    partition_by=None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    where=None,
) -> DataFrame:
    """Ranges that are empty, unbounded, or at odds with the next range of their group.

    ``is_last_record`` marks the range with the largest lower bound, then the largest upper bound, of its group; a null bound is smallest.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {', '.join(GAP_RULES)}, got {gaps!r}")
    gap_words, fits = GAP_RULES[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"

    if partition_by is None:
        groups = []
    elif isinstance(partition_by, (str, Column)):
        groups = [_expression(partition_by).alias("partition_by_col")]
    else:
        groups = [as_column(key) for key in partition_by]
    ranges = _rows(df, where).select(
        *groups, _expression(lower_bound).alias("lower_bound"), _expression(upper_bound).alias("upper_bound")
    )
    keys = ranges.columns[: len(groups)]
    counted = counted_rows(ranges, [*keys, "lower_bound", "upper_bound"])

    lower, upper, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    ordered = F.coalesce(lower <= upper if zero_length_range_allowed else lower < upper, F.lit(False))
    length_flag, gap_flag = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{gap_words}_next_lower_bound"

    def in_step(next_bound: Column) -> Column:
        # A range without a following lower bound ends its group, unless it lacks a bound itself, which fails the length rule anyway.
        return F.coalesce(fits(upper, next_bound), next_bound.isNull() & lower.isNotNull(), F.lit(False))

    def fails(near: Column) -> Column:
        return ~(ordered & in_step(near["lower_bound"]))

    steps = distinct_steps(counted, keys, ["lower_bound", "upper_bound"], ["lower_bound"], -1, fails)
    judged = steps.withColumn("next_lower_bound", F.col("near")["lower_bound"]).withColumn(length_flag, ordered).drop("near")
    # Which record is last matters for failing rows only. It is found among the counted rows: the counts are asked for here too, so
    # that both sides share one aggregation of the input.
    top = counted.groupBy(*keys).agg(F.max(F.struct("lower_bound", "upper_bound")).alias("top"), F.sum("__count").alias("__rows"))
    top = top.filter("__rows > 0").drop("__rows")
    if keys:
        same = reduce(lambda a, b: a & b, [F.col(f"judged.{key}").eqNullSafe(F.col(f"tops.{key}")) for key in keys])
        judged = judged.alias("judged").join(top.alias("tops"), same).select("judged.*", "top")
    else:
        judged = judged.withColumn("top", top.scalar())
    last = F.col("outer") & F.struct("lower_bound", "upper_bound").eqNullSafe(F.col("top"))
    judged = judged.withColumn("is_last_record", last).withColumn(gap_flag, F.coalesce(fits(upper, following), last, F.lit(False)))
    shown = [*keys, "lower_bound", "upper_bound", "next_lower_bound", "is_last_record", length_flag, gap_flag]
    return repeat_rows(judged.drop("outer", "top"), "copies").select(*shown)


# --- checks against another table ---


def relationships_where(df: DataFrame, column, to: DataFrame, field, from_condition=None, to_condition=None, where=None) -> DataFrame:
    """Non-null values without a match in ``to``, once per row.

    Both sides are reduced to distinct values first, so a value that fills much of a
    table neither moves nor joins more than once.
    """
    left = _rows(_rows(df, where), from_condition).select(as_column(column).alias("id")).filter("id is not null")
    right = _rows(to, to_condition).select(as_column(field).alias("id")).filter("id is not null").distinct()
    orphans = left.groupBy("id").agg(F.count(F.lit(1)).alias("__rows")).join(right, "id", "left_anti")
    id_type = left.schema["id"].dataType
    return repeat_rows(orphans, "__rows").select("id", F.lit(None).cast(id_type).alias("right_id"))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str, where=None) -> DataFrame:
    """Values whose number of rows differs between the two tables, one row per side."""
    counts = side_counts(
        _rows(df, where).select(as_column(column).alias("__value")), to.select(as_column(field).alias("__value"))
    )
    differing = counts.filter(F.col(COUNT_A) != F.col(COUNT_B))
    sides = differing.select("__value", F.explode(F.array(COUNT_A, COUNT_B)).alias("num_rows"))
    return sides.filter("num_rows > 0").withColumnRenamed("__value", column)


def _comparable(counts: DataFrame, keys, strict: bool) -> DataFrame:
    """Without ``strict``: only groups on both sides, and none with a null key."""
    if strict or not keys:
        return counts
    shared = (F.col(COUNT_A) > 0) & (F.col(COUNT_B) > 0)
    for key in keys:
        shared = shared & F.col(key).isNotNull()
    return counts.filter(shared)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by=(), strict: bool = True, where=None) -> DataFrame:
    """Groups with different row counts; weigh them by ``diff_count``."""
    keys = list(group_by)
    counts = _comparable(side_counts(_rows(df, where).select(*keys), compare.select(*keys)), keys, strict)
    difference = F.abs(F.col(COUNT_A) - F.col(COUNT_B))
    return counts.withColumn("diff_count", difference).filter("diff_count > 0")


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by=(), strict: bool = True, where=None) -> DataFrame:
    """Groups that do not have fewer rows than in ``compare``; equal counts weigh 1."""
    keys = list(group_by)
    counts = _comparable(side_counts(_rows(df, where).select(*keys), compare.select(*keys)), keys, strict)
    ours, theirs = F.col(COUNT_A), F.col(COUNT_B)
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return (
        counts.withColumn("row_count_delta", delta)
        .filter("row_count_delta > 0")
        .withColumnsRenamed({COUNT_A: "count_our_model", COUNT_B: "count_comparison_model"})
    )


def equality(
    df: DataFrame,
    compare: DataFrame,
    compare_columns=None,
    exclude_columns=None,
    precision: int | None = None,
    multiset: bool = False,
    where=None,
    digests: bool = False,
) -> DataFrame:
    """Rows found on one side only, labelled by side.

    Repeats are ignored unless ``multiset`` is set. ``precision`` rounds fractional numbers first. ``digests`` is for tables that are expected to be
    equal: parts of both are first compared by digest, and only rows of parts that differ are shuffled; equal tables shuffle no row.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    rows = _rows(df, where)
    if compare_columns:
        columns = as_list(compare_columns)
    else:
        columns = filtered_columns(df, exclude_columns or ())
        others = filtered_columns(compare, exclude_columns or ())
        if {name.lower() for name in columns} != {name.lower() for name in others}:
            raise ValueError("the tables have different columns; use compare_columns or exclude_columns")

    def shaped(side: DataFrame) -> DataFrame:
        return side.select(*[_rounded(side, name, precision).alias(name) for name in columns])

    sides = shaped(rows), shaped(compare)
    counts = side_counts(*(only_differing(*sides) if digests else sides))
    a, b = F.col(COUNT_A), F.col(COUNT_B)
    label = F.when(a > b, "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    columns = [F.col(f"`{name}`") for name in columns]
    if multiset:
        surplus = counts.filter(a != b).select(label, *columns, F.abs(a - b).alias("__copies"))
        return repeat_rows(surplus, "__copies")
    return counts.filter((a == 0) | (b == 0)).select(label, *columns)


def _rounded(df: DataFrame, name: str, precision: int | None) -> Column:
    column = F.col(f"`{name}`")
    fractional = isinstance(df.schema[df.select(column).columns[0]].dataType, (FloatType, DoubleType, DecimalType))
    return F.round(column, precision) if precision is not None and fractional else column


def columns_match_set(df: DataFrame, columns) -> DataFrame:
    """Expected columns that are missing and columns nobody expected; reads no rows."""
    expected, actual = {name.lower() for name in columns}, {name.lower() for name in df.columns}
    unmatched = [(name, None) for name in sorted(expected - actual)] + [(None, name) for name in sorted(actual - expected)]
    schema = StructType([StructField("expected_column", StringType()), StructField("actual_column", StringType())])
    return df.sparkSession.createDataFrame(unmatched, schema)
