"""Recorded checks: the report of a full scan, from the partitions that changed."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.operators.checks import is_missing, is_out_of_range
from tidemark.operators.suite import RowCheck, Thresholds, run_row_checks
from tidemark.sources.tables import upsert

SCHEMA = "k int, v double, t string, p int"


def some_checks():
    return [
        RowCheck("known", is_missing("v")),
        RowCheck("small", is_out_of_range("v", max_value=50), where="t = 'x'", thresholds=Thresholds(severity="warn", warn_if="> 3")),
        RowCheck("text", F.col("t") == ""),
    ]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(i, None if i % 9 == 0 else float(i), "xy"[i % 2], i % 8) for i in range(200)]
    upsert(spark, path, spark.createDataFrame(rows, SCHEMA), ["k"], ["p"])
    return path


def report(spark, path, checks=None):
    checks = checks or some_checks()
    return sorted(tuple(row) for row in ledger.run_recorded_checks(spark, path, f"{path}_ledger", checks, SCHEMA).collect())


def full(spark, path, checks=None):
    checks = checks or some_checks()
    return sorted(tuple(row) for row in run_row_checks(spark.read.schema(SCHEMA).parquet(path), checks).collect())


def test_reports_are_those_of_a_full_scan(spark, stored):
    assert report(spark, stored) == full(spark, stored) == report(spark, stored)
    upsert(spark, stored, spark.createDataFrame([(5, None, "x", 5), (300, 99.0, "", 9), (6, 7.0, "x", 1)], SCHEMA), ["k"], ["p"])
    assert report(spark, stored) == full(spark, stored)
    other = [*some_checks(), RowCheck("small", is_out_of_range("v", max_value=20))]  # a new definition under an old name
    assert report(spark, stored, other) == full(spark, stored, other)
    assert report(spark, stored, some_checks()[:1]) == full(spark, stored, some_checks()[:1])


def test_unchanged_partitions_are_not_read(spark, stored):
    wanted = {name: n for name, n, _ in report(spark, stored)}
    upsert(spark, stored, spark.createDataFrame([(3, None, "x", 3)], SCHEMA), ["k"], ["p"])
    for file in glob.glob(f"{stored}/p=*/*.parquet"):
        if "p=3" not in file:
            os.truncate(file, 0)
    assert {name: n for name, n, _ in report(spark, stored)} == wanted | {"known": wanted["known"] + 1}


def test_a_run_that_breaks_off_is_made_up_for(spark, stored, monkeypatch):
    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "scan", broken)
        with pytest.raises(RuntimeError):
            report(spark, stored)
    assert report(spark, stored) == full(spark, stored)


def test_an_empty_table_and_no_checks(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.createDataFrame([], SCHEMA).write.partitionBy("p").parquet(path)
    assert report(spark, path, some_checks()[:1]) == [("known", 0, "pass")]
    with pytest.raises(ValueError):
        ledger.run_recorded_checks(spark, path, f"{path}_ledger", [])
