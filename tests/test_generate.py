from __future__ import annotations

import datetime as dt

import pytest

from tidemark.operators import generate


def column(df):
    return sorted(row[0] for row in df.collect())


def test_series(spark):
    assert column(generate.series(spark, 10)) == list(range(1, 11))
    with pytest.raises(ValueError):
        generate.series(spark, 0)


def test_day_spine_leaves_out_its_end(spark):
    spine = generate.date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    assert spine.dtypes == [("date_day", "date")]
    assert column(spine) == [dt.date(2018, 1, day) for day in range(1, 10)]


@pytest.mark.parametrize(
    "start, end, months",
    [
        (dt.date(2020, 1, 15), dt.date(2020, 3, 20), [dt.date(2020, 1, 15), dt.date(2020, 2, 15)]),
        (dt.date(2020, 1, 31), dt.date(2020, 4, 1), [dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 31)]),
        (dt.date(2020, 1, 31), dt.date(2020, 1, 1), []),
    ],
)
def test_month_spine_steps_from_its_start(spark, start, end, months):
    assert column(generate.date_spine(spark, "month", start, end)) == months


def test_hour_spine_from_text(spark):
    spine = generate.date_spine(spark, "hour", "2020-01-01 00:30:00", "2020-01-01 03:00:00")
    assert column(spine) == [dt.datetime(2020, 1, 1, hour, 30) for hour in range(3)]


def test_intervals_between(spark):
    assert generate.intervals_between(spark, dt.date(2020, 1, 31), dt.date(2020, 2, 28), "month") == 1
    assert generate.intervals_between(spark, None, dt.date(2020, 2, 28), "month") == 1
