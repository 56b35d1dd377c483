"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as contract  # noqa: E402
from verify import compare, duckdb_connection  # noqa: E402
from workloads import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_connection(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, connection, name):
    problem = compare(spark, connection, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert problem is None or "EMPTY" in problem, problem


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_the_contract_holds_these_queries():
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_bench_queries_are_registered():
    text = open(os.path.join(ROOT, "bench.py")).read()
    assert set(re.findall(r'"((?:mart|check)_\w+)"', text)) <= contract.queries().keys()
