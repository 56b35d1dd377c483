"""Number series and date spines, made by the tasks themselves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import boundary_count, check_unit, shift


def series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1 … ``upper_bound``."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).toDF("generated_number")


def _moment(value):
    moment = F.lit(value)
    is_date = isinstance(value, dt.date) and not isinstance(value, dt.datetime)
    return moment.cast("date" if is_date else "timestamp_ntz")


def intervals_between(spark: SparkSession, start, end, datepart: str) -> int:
    """Unit boundaries between two dates or times; 1 if either is null."""
    count = spark.range(1).select(boundary_count(_moment(start), _moment(end), datepart)).first()[0]
    return 1 if count is None else int(count)


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """One row per ``datepart`` from ``start``, up to but without the last boundary at ``end``.

    Every step is counted from ``start``, so month ends do not drift. Dates stay dates for
    steps of a day or more.
    """
    unit = check_unit(datepart)
    name = f"date_{unit}"
    count = intervals_between(spark, start, end, unit)
    step = shift(unit, F.col("id"), _moment(start).cast("timestamp_ntz"))
    is_date = isinstance(start, dt.date) and not isinstance(start, dt.datetime)
    if is_date and unit not in ("hour", "minute", "second"):
        step = step.cast("date")
    spine = spark.range(max(count, 0)).select(step.alias(name))
    return spine.filter(F.col(name) <= _moment(end))
