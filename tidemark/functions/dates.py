"""Calendar arithmetic on dates and zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column, as_operand

CALENDAR_UNITS = ("year", "quarter", "month")
FIXED_UNITS = ("week", "day", "hour", "minute", "second")
UNITS = CALENDAR_UNITS + FIXED_UNITS


def check_unit(unit: str) -> str:
    unit = unit.lower()
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}, got {unit!r}")
    return unit


def shift(unit: str, count, column) -> Column:
    """``column`` moved by ``count`` units; month ends are clipped, not carried over."""
    return F.timestamp_add(check_unit(unit).upper(), as_operand(count), as_column(column))


def boundary_count(start, end, unit: str) -> Column:
    """Number of unit boundaries crossed between two times, not of full units passed."""
    unit = check_unit(unit)
    start, end = as_column(start), as_column(end)
    if unit in CALENDAR_UNITS:
        def index(moment: Column) -> Column:
            year = F.year(moment)
            if unit == "year":
                return year
            return year * 4 + F.quarter(moment) if unit == "quarter" else year * 12 + F.month(moment)

        return (index(end) - index(start)).cast("bigint")
    if unit == "day":
        return F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))


def month_start(year, month) -> Column:
    return F.make_date(as_column(year), as_column(month), F.lit(1))


def to_date_or_null(column, pattern: str | None = None) -> Column:
    return F.try_to_date(as_column(column), pattern) if pattern else as_column(column).try_cast("date")
