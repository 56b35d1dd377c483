"""Casts that yield null on bad input, and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column

# Trend labels and the mark shown for a missing figure.
TREND_UP = "alta"
TREND_DOWN = "queda"
TREND_FLAT = "estavel"
TREND_UNKNOWN = "sem_dado"
TREND_LABELS = (TREND_UP, TREND_DOWN, TREND_FLAT, TREND_UNKNOWN)
MISSING_MARK = "–"


def safe_cast(column, data_type: str) -> Column:
    return as_column(column).try_cast(data_type)


def blank_to_null(column) -> Column:
    return F.nullif(as_column(column), F.lit(""))


def bool_to_text(column) -> Column:
    return as_column(column).cast("string")


def trend_label(change) -> Column:
    """Direction of a change; null means that there is nothing to compare with."""
    change = as_column(change)
    return (
        F.when(change > 0, TREND_UP)
        .when(change < 0, TREND_DOWN)
        .when(change == 0, TREND_FLAT)
        .otherwise(TREND_UNKNOWN)
    )


def format_kpi(column, decimals: int = 1, prefix: str = "", suffix: str = "") -> Column:
    """A figure for display with fixed decimals; null and NaN show as a dash."""
    value = as_column(column).cast("double")
    shown = F.format_string(f"%.{decimals}f", F.bround(value, decimals))
    return F.when(value.isNull() | F.isnan(value), MISSING_MARK).otherwise(
        F.concat(F.lit(prefix), shown, F.lit(suffix))
    )
