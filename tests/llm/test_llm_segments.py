"""Top-k search against all products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import segments


def brute(vectors, queries, top):
    whole = lambda v: [math.floor(1024 * x) for x in v]
    good = lambda i, v: i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    held = [(i, whole(v)) for i, v in vectors if good(i, v)]
    out = []
    for q, v in sorted({(i, tuple(whole(v))) for i, v in queries if good(i, v)}):
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in held if i != q and len(w) == len(v)]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return out


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")


def found(vectors, queries, top=10):
    return sorted(tuple(r) for r in segments.top_pairs(vectors, queries, top).collect())


@pytest.mark.parametrize(("count", "dim", "top"), [(700, 16, 10), (40, 64, 3), (5, 3, 10)])
def test_against_all_products(table, count, dim, top, monkeypatch):
    monkeypatch.setattr(segments, "BLOCK_BYTES", 8 * dim * 64)
    monkeypatch.setattr(segments, "QUERY_ROWS", 7)
    monkeypatch.setattr(segments, "ROUND_BYTES", 8 * dim * 15)
    chance = np.random.default_rng(count)
    rows = [(i, chance.normal(0, 0.2, dim).astype(np.float32).tolist()) for i in range(count)]
    rows += [(count + i, rows[0][1]) for i in range(20)]  # ties
    assert found(table(rows), table(rows).filter("vec_id % 10 = 0"), top) == brute(rows, [r for r in rows if r[0] % 10 == 0], top)


def test_edges(table):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]), (5, [])]
    rows += [(6, [0.5, 0.5]), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [1.0, 2.0, 3.0]), (9, [-1.0, -2.0]), (10, [0.0, 0.0]), (10, [0.0, 0.0])]
    df = table(rows)
    assert found(df, df) == brute(rows, rows, 10)
    assert found(df.limit(0), df) == [] and found(df, df.limit(0)) == []


def test_numbers_beyond_doubles_stay_exact(table):
    rows = [(i, [1e12 + 4096 * i, -1e12 + 8192.0 * i, 3.0]) for i in range(12)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    limit = lambda x: max(-(2**63), min(2**63 - 1, x))
    wanted = [(q, s) for q, _, _, s in brute(rows, rows[:2], 4)]
    assert [(q, s) for q, _, _, s in found(table(rows), table(rows[:2]), 4)] == [(q, limit(s)) for q, s in wanted]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5), st.integers(0, 1000))
def test_bounds_hold(dim, parts, seed):
    chance = np.random.default_rng(seed)
    a, b = np.floor(chance.normal(0, 300, (2, 8, dim)))
    assert (segments.statistics(a, parts) @ segments.statistics(b, parts).T + 1e-3 >= a @ b.T).all()
