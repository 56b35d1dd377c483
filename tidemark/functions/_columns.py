from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    """A column name or a Column, as a Column."""
    return value if isinstance(value, Column) else F.col(value)


def as_operand(value) -> Column:
    """Like ``as_column``, but anything that is not a string is a literal."""
    return as_column(value) if isinstance(value, (str, Column)) else F.lit(value)


def as_predicate(condition) -> Column:
    """A SQL boolean expression or a Column, as a Column."""
    return condition if isinstance(condition, Column) else F.expr(condition)


def as_list(fields) -> list:
    """Refuse a bare string where a list of fields is meant."""
    if isinstance(fields, (str, Column)) or not isinstance(fields, Iterable):
        raise TypeError("expected a list of columns")
    fields = list(fields)
    if not fields:
        raise ValueError("expected at least one column")
    return fields
