"""Winnowing against the definition."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def judged(text, items, window=13):
    words, hit, named = cut(text), set(), set()
    for item_id, item in items:
        own = cut(item)
        n = min(len(own), window)
        spans = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in spans:
                hit.update(range(i, i + n))
                named.add(item_id)
    listed = ",".join(sorted(str(i) for i in named if i is not None))
    bad = bool(hit) and 20 * len(hit) >= len(words)
    return len(words), len(hit), len({i for i in named if i is not None}), hashlib.sha256(listed.encode()).hexdigest(), bad


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string, row string")


def found(docs, items, **more):
    return sorted((str(r.doc_id), (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in winnow.contamination(docs, items, **more).collect())


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80))
def test_words(data):
    text = data.decode("utf-8", "ignore")
    assert [w.decode() for w in winnow.words(text.encode())] == cut(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 13))
def test_every_long_shared_span_has_a_common_hash(left, right, length):
    left, right = (np.array(x, np.uint64) for x in (left, right))
    kept = [dict(zip(*(a.tolist() for a in winnow.winnowed(x, length)))) for x in (left, right)]
    k = (length + 1) // 2
    for i in range(len(left) - length + 1):
        for j in range(len(right) - length + 1):
            if (left[i : i + length] == right[j : j + length]).all():
                shared = [o for o in range(length - k + 1) if i + o in kept[0] and j + o in kept[1] and kept[0][i + o] == kept[1][j + o]]
                assert shared


@pytest.mark.parametrize("window", [13, 5])
def test_against_the_definition(documents, items, window):
    chance = random.Random(3)
    make = lambda n: " ".join(chance.choice("ab cd ef gh ij Kl MN öp".split()) for _ in range(n))
    given_items = [(i, make(chance.choice([1, 2, 3, 6, 12, 13, 14, 30]))) for i in range(14)] + [(3, make(20)), (None, make(15)), (20, ""), (21, None)]
    texts = [make(chance.choice([0, 1, 5, 13, 40, 90])) for _ in range(40)]
    texts += [f"{make(6)} {given_items[i][1]} {make(4)}" for i in range(14)]
    texts += [f"{make(400)} {given_items[-3][1]}", given_items[0][1], given_items[-3][1]]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    got = found(documents(rows), items([(*row, "x") for row in given_items]), window_words=window)
    assert got == sorted((str(i), judged(t, given_items, window)) for i, t in rows)


def test_edges(edge_documents, no_documents, items):
    given_items = items([(1, "the same text in two documents", "x"), (2, "word", "x"), (1, "the same text in two documents", "x")])
    got = found(edge_documents, given_items)
    rows = [(1, "the same text in two documents"), (2, "word")]
    assert got == sorted((str(r.doc_id), judged(r.text, rows)) for r in edge_documents.collect())
    assert found(no_documents, given_items) == []
    empty = winnow.contamination(edge_documents, items([])).collect()
    assert len(empty) == edge_documents.count() and not any(r.n_hit or r.contaminated for r in empty)


def test_a_full_bit_table_changes_nothing(documents, items, monkeypatch):
    monkeypatch.setattr(winnow, "LEAST_BITS", 64)
    monkeypatch.setattr(winnow, "MOST_BITS", 64)
    rows = [(i, f"a{i} b c d e f g h i j k l m n{i}") for i in range(30)]
    assert found(documents(rows), items([(i, t, "x") for i, t in rows[:20]])) == sorted((str(i), judged(t, rows[:20])) for i, t in rows)


def test_clean_rows_stay_whole(edge_documents, items):
    kept = winnow.without_contaminated(edge_documents, items([(1, "the same text in two documents", "x")]))
    assert kept.columns == edge_documents.columns
    assert kept.count() == edge_documents.count() - 2


def test_the_bit_table_grows_with_the_benchmark(documents, items, monkeypatch):
    assert [winnow.table_bits(n) for n in (0, 1000, 1 << 17, 10**9)] == [winnow.LEAST_BITS, winnow.LEAST_BITS, 1 << 23, winnow.MOST_BITS]
    monkeypatch.setattr(winnow, "LEAST_BITS", 64)
    text = " ".join(f"w{i}" for i in range(40))
    found = winnow.contamination(documents([(1, text), (2, "other words")]), items([(5, " ".join(f"w{i}" for i in range(10, 30)), "x")])).collect()
    assert sorted((r.doc_id, r.n_hit, r.n_items) for r in found) == [(1, 20, 1), (2, 0, 0)]
