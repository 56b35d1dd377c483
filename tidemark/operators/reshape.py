"""Column selection, pivot and unpivot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column, as_list
from tidemark.functions.keys import slug
from tidemark.functions.text import blank_to_null


def filtered_columns(df: DataFrame, except_=()) -> list[str]:
    """Column names other than ``except_``, case ignored."""
    left_out = {name.lower() for name in except_}
    return [name for name in df.columns if name.lower() not in left_out]


def star_columns(df: DataFrame, except_=(), prefix: str = "", suffix: str = "", relation_alias: str | None = None) -> list[Column]:
    """All columns but ``except_``, renamed with prefix and suffix, for use in a select."""
    source = f"{relation_alias}." if relation_alias else ""
    return [
        F.col(f"{source}`{name}`").alias(f"{prefix}{name}{suffix}") for name in filtered_columns(df, except_)
    ]


def star(df: DataFrame, except_=(), prefix: str = "", suffix: str = "") -> DataFrame:
    return df.select(*star_columns(df, except_, prefix, suffix))


def nullcheck_columns(df: DataFrame) -> list[Column]:
    return [
        blank_to_null(f"`{name}`").alias(name) if data_type == "string" else F.col(f"`{name}`")
        for name, data_type in df.dtypes
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Empty strings become null in every string column."""
    return df.select(*nullcheck_columns(df))


def group_by_first(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def _literal(value) -> str:
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def pivot_columns(
    column: str,
    values,
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value="1",
    else_value="0",
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate per value: ``agg(case when column cmp value then … else … end)``.

    ``column``, ``then_value`` and ``else_value`` are SQL expressions, the values are text.
    """
    each = "distinct " if distinct else ""
    pivoted = []
    for value in values:
        case = f"case when {column} {cmp} {_literal(value)} then {then_value} else {else_value} end"
        aggregate = F.expr(f"{agg}({each}{case})")
        name = f"{prefix}{value}{suffix}"
        pivoted.append(aggregate.alias(name if quote_identifiers else slug(name)) if alias else aggregate)
    return pivoted


def pivot(df: DataFrame, group_by, column: str, values, **options) -> DataFrame:
    """Rows to columns in one aggregation per group; options as in ``pivot_columns``.

    Distinct counts of a column against nothing reduce the table to distinct values once, however many values are pivoted.
    """
    plain = {"distinct": True, "agg": "count", "cmp": "=", "else_value": "null"}
    if all(str(options.get(name, "=" if name == "cmp" else None)).lower() == str(wanted).lower() for name, wanted in plain.items()):
        keys = as_list(group_by)
        names = [f"__key{i}" for i in range(len(keys))]
        then = options.get("then_value", "1")
        named = [as_column(key).alias(name) for key, name in zip(keys, names)]
        rows = df.select(*named, F.expr(column).cast("string").alias("__column"), F.expr(str(then)).alias("__then"))
        labels = df.select(*keys).columns
        rest = {name: value for name, value in options.items() if name not in ("distinct", "then_value")}
        counted = rows.distinct().groupBy(*names).agg(*pivot_columns("__column", values, then_value="__then", **rest))
        return counted.withColumnsRenamed(dict(zip(names, labels)))
    return df.groupBy(*as_list(group_by)).agg(*pivot_columns(column, values, **options))


def pivot_fixed(df: DataFrame, group_by, column: str, value, names: Mapping[str, str]) -> DataFrame:
    """Largest ``value`` per listed entry of ``column``; ``names`` maps entry to output column."""
    value = as_column(value)
    aggregates = [F.max(F.when(F.col(column) == entry, value)).alias(name) for entry, name in names.items()]
    return df.groupBy(*as_list(group_by)).agg(*aggregates)


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude=(),
    remove=(),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in one scan; ``exclude`` stays as it is, ``remove`` goes. Nulls are kept."""
    measured = filtered_columns(df, [*exclude, *remove])
    cast = [F.col(f"`{name}`").cast(cast_to).alias(name) for name in measured]
    kept = df.select(*[F.col(f"`{name}`") for name in exclude], *cast)
    return kept.unpivot(list(exclude), measured, field_name, value_name)
