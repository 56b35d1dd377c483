"""Stratified search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical


def terms(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranked(docs, items, top=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, tf) for doc_id, tf in counted if tf]
    n, total = len(counted), sum(sum(tf.values()) for _, tf in counted)
    df = Counter(term for _, tf in counted for term in tf)
    found = []
    for item_id, text in {(item_id, text) for item_id, text in items}:
        scores = []
        for doc_id, tf in counted:
            m = 25 + (75 * sum(tf.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms(text) if tf[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scores)[:top], 1)]
    return sorted(found, key=str)


def corpus(count=300, vocabulary=60, seed=4):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(vocabulary)] + ["Größe", "中文", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.choice((0, 1, 5, 20, 20, 20, 200))))) for i in range(count)]


@pytest.fixture
def items(spark):
    def create(rows):
        return spark.createDataFrame(rows, "item_id string, text string").withColumn("number", F.lit("x"))

    return create


def found(index, items, **options):
    return sorted((tuple(row) for row in lexical.search(index, items, **options).collect()), key=str)


ITEMS = [("a", "t1 t2 T3, t3!"), ("b", "größe Größe 中文 a1"), ("c", "nothing here"), ("d", ""), ("e", None), (None, "t50 t51 t52 t53"), ("a", "t7")]


@pytest.mark.parametrize("postings", [1, 50, 1 << 18])
def test_against_all_scores(documents, items, postings):
    docs = corpus()
    index = lexical.build_index(documents(docs), postings)
    assert found(index, items(ITEMS + [ITEMS[0]])) == ranked(docs, ITEMS)


def test_rounds_and_top(documents, items):
    docs = corpus(100)
    index = lexical.build_index(documents(docs))
    assert found(index, items(ITEMS), item_bytes=30, top=3) == ranked(docs, ITEMS, 3)


def test_small_portions(documents, items, monkeypatch):
    """Blocks that a task cannot order together are still all visited when their bounds ask for it."""
    monkeypatch.setattr(lexical, "HELD_BYTES", 1)
    docs = corpus(150, seed=9)
    assert found(lexical.build_index(documents(docs), 30), items(ITEMS)) == ranked(docs, ITEMS)


def test_ties_and_copies(documents, items):
    docs = [(90 - i, "same words here") for i in range(40)] + [(None, "same words here"), (5, "same words here"), (5, "same words here")]
    docs += [(200 + i, f"other text {i}") for i in range(60)]
    index = lexical.build_index(documents(docs))
    assert found(index, items([("x", "words")])) == ranked(docs, [("x", "words")])
    assert [r[2] for r in sorted(found(index, items([("x", "words")])), key=lambda r: r[1])][:3] == [5, 5, 51]


def test_edges(edge_documents, no_documents, items):
    given = [(r.doc_id, r.text) for r in edge_documents.collect()]
    asked = [("p", "the same text in two documents"), ("q", "word end"), ("r", "id text straße ñandú 12345")]
    assert found(lexical.build_index(edge_documents), items(asked)) == ranked(given, asked)
    assert found(lexical.build_index(no_documents), items(asked)) == []
    assert found(lexical.build_index(edge_documents), items([])) == []


def test_a_large_stratum_is_dealt(spark, documents):
    """Documents of one length are a third of all rows and more: their stratum lies in several partitions and blocks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    docs = [(i, f"one two three w{i}") for i in range(500)] + [(1000 + i, "x " * (i + 5)) for i in range(50)]
    index = lexical.build_index(documents(docs))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    blocks = index.blocks.groupBy("m").count().agg(F.max("count")).first()[0]
    assert blocks > 3


def test_bounds_hold():
    """No document of a block scores above the block's bound."""
    docs = [lexical.counted_terms(text.encode())[1:] for _, text in corpus(80, seed=2) if text]
    row = lexical.pack_block(90, list(range(len(docs))), *(list(x) for x in zip(*docs)))
    rows = [(i, *(x.tobytes() for x in lexical.counted_terms((text or "").encode())[1:])) for i, (_, text) in enumerate(ITEMS) if terms(text)]
    items = lexical.Items.of(rows)
    weights = lexical.term_weights(items.places[: len(items.terms)] * 0 + 3, 80)
    block = lexical._Block(row, items, weights)
    for item in range(len(rows)):
        scores, _ = block.best(items, item, 1, 0)
        assert not len(scores) or scores.max() <= block.bound[item]
