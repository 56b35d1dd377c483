"""Bronze tables whose columns change type from load to load."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tidemark.sources import evolution, landing


@pytest.mark.parametrize(
    ("a", "b", "wanted"),
    [
        (T.ByteType(), T.LongType(), T.LongType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.FloatType(), T.FloatType(), T.FloatType()),
        (T.LongType(), T.DecimalType(10, 4), T.DecimalType(24, 4)),
        (T.DecimalType(12, 2), T.DecimalType(9, 6), T.DecimalType(16, 6)),
        (T.DecimalType(38, 0), T.DecimalType(38, 30), T.DoubleType()),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.BooleanType(), T.IntegerType(), T.StringType()),
        (T.StringType(), T.DateType(), T.StringType()),
        (T.NullType(), T.DateType(), T.DateType()),
    ],
)
def test_least_common_type(a, b, wanted):
    assert evolution.least_common_type(a, b) == evolution.least_common_type(b, a) == wanted


def test_the_lattice_is_associative():
    kinds = [T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DecimalType(8, 2)]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                join = evolution.least_common_type
                if T.BooleanType() not in (a, b, c):  # numbers beside a truth value are text, whatever they are among themselves
                    assert join(join(a, b), c) == join(a, join(b, c))


def test_a_structure_and_a_number_have_no_common_type():
    with pytest.raises(ValueError):
        evolution.least_common_type(T.ArrayType(T.LongType()), T.LongType())


def test_loads_of_other_types(spark, table, tmp_path, rows):
    path = str(tmp_path / "bronze")
    loads = [
        ("k string, v int, d date", ("a", 1, dt.date(2020, 1, 2))),
        ("k string, v double", ("b", 2.5)),
        ("k string, v int, extra string", ("c", 3, "x")),
        ("K string, v decimal(10,2)", ("d", Decimal("4.25"))),
        ("k string, v double, d timestamp_ntz", ("e", 5.5, dt.datetime(2021, 1, 1, 3))),
        ("k long, v int", (6, 6)),
    ]
    for schema, row in loads:
        assert landing.append_bronze(table(schema, row), path) == 1
    found = landing.read_bronze(spark, path)
    assert {f.name: f.dataType.simpleString() for f in found.schema} == {"k": "string", "v": "double", "d": "timestamp_ntz", "extra": "string"}
    assert rows(found.select("k", "v", "d", "extra")) == [
        ("6", 6.0, None, None),
        ("a", 1.0, dt.datetime(2020, 1, 2), None),
        ("b", 2.5, None, None),
        ("c", 3.0, None, "x"),
        ("d", 4.25, None, None),
        ("e", 5.5, dt.datetime(2021, 1, 1, 3), None),
    ]
    # Loads of the same types share a part: integers with the first, doubles with the second.
    assert len(evolution.parts(spark, path)) == 4


def test_a_table_without_a_ledger(spark, table, tmp_path, rows):
    """Tables written before there were ledgers are asked for their types once."""
    path = str(tmp_path / "old")
    table("k int", (1,)).write.parquet(path)
    landing.append_bronze(table("k int, v int", (2, 2)), path)
    landing.append_bronze(table("k double", (0.5,)), path)
    assert rows(landing.read_bronze(spark, path)) == [(0.5, None), (1.0, None), (2.0, 2)]
    assert len(evolution.parts(spark, path)) == 2


def test_many_loads_of_one_type_are_one_part(spark, table, tmp_path):
    path = str(tmp_path / "one")
    for i in range(4):
        landing.append_bronze(table("k int, v double", (i, i / 2)), path)
    assert evolution.parts(spark, path) == [path] and landing.read_bronze(spark, path).count() == 4
