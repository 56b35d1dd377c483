"""Raking against targets and sampling against a plain count."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def flattened(rows):
    """Expected source targets from (source, tokens): square roots of the sources' tokens."""
    held = Counter()
    for source, tokens in rows:
        held[source] += tokens
    roots = {source: tokens**0.5 for source, tokens in held.items() if source is not None and tokens}
    roots[mixing.OTHER] = held[None] ** 0.5
    total = sum(roots.values())
    return {source: root / total for source, root in roots.items()} if total else {mixing.OTHER: 1.0}


def fitted(tokens, targets, budget):
    """Iterative proportional fitting, one axis after the other, where no cell runs out."""
    cells = {place: float(n) for place, n in np.ndenumerate(tokens)}
    total = sum(cells.values())
    cells = {place: n * budget / total for place, n in cells.items()}
    for _ in range(2000):
        for axis, target in enumerate(targets):
            sums = Counter()
            for place, n in cells.items():
                sums[place[axis]] += n
            cells = {place: n * target[place[axis]] * budget / sums[place[axis]] if sums[place[axis]] else 0.0 for place, n in cells.items()}
    return cells


@pytest.mark.parametrize("seed", range(4))
def test_rake_is_iterative_proportional_fitting(seed):
    chance = np.random.default_rng(seed)
    tokens = chance.integers(0, 400, (5, 3, 4)).astype(float) * (chance.random((5, 3, 4)) < 0.8)
    targets = [chance.random(n) + 0.2 for n in tokens.shape]
    targets = [t / t.sum() for t in targets]
    wanted = fitted(tokens, targets, 30.0)  # small against every cell
    found = mixing.rake(tokens, targets, 30.0)
    assert all(abs(found[place] - n) < 1e-4 for place, n in wanted.items())


def test_rake_meets_all_marginals():
    tokens = np.random.default_rng(2).integers(1000, 5000, (4, 3, 2)).astype(float)
    targets = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.3, 0.2]), np.array([0.7, 0.3])]
    wanted = mixing.rake(tokens, targets, 0.2 * tokens.sum())
    assert (wanted <= tokens).all()
    for axis, target in enumerate(targets):
        rest = tuple(i for i in range(3) if i != axis)
        assert np.allclose(wanted.sum(axis=rest) / wanted.sum(), target, atol=1e-6)
    # Raking keeps the odds of the cells: what it multiplies by factors over the axes.
    odds = wanted / tokens
    assert np.allclose(odds[0, 0, 0] * odds[1, 1, 0], odds[0, 1, 0] * odds[1, 0, 0])


def test_exhausted_cells_and_missing_values():
    tokens = np.array([[10.0, 0.0], [1000.0, 1000.0]])
    wanted = mixing.rake(tokens, [np.array([0.5, 0.5]), np.array([0.5, 0.5])], 400)
    assert wanted[0, 0] == 10 and abs(wanted.sum() - 400) < 1 and (wanted <= tokens).all()
    only = mixing.rake(np.array([[5.0, 0.0]]), [np.array([1.0]), np.array([0.2, 0.8])], 2)
    assert np.allclose(only, [[2.0, 0.0]])
    assert mixing.rake(np.zeros((2, 2)), [np.ones(2), np.ones(2)], 0).sum() == 0


@pytest.fixture
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_probabilities_follow_the_cells(docs):
    rows = mixing.mixed(docs).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    sources = flattened((r.source, len(r.text.split())) for r in texts.values())
    axes = [{mixing.OTHER: 0.0, **a} for a in (sources, mixing.LANGUAGES, mixing.TOPICS)]
    shape = [len(a) for a in axes]
    tokens, where = np.zeros(shape), {}
    for r in rows:
        assert r.n_tokens == len(texts[r.doc_id].text.split())
        where[r.doc_id] = tuple(list(a).index(v if v in a else mixing.OTHER) for a, v in zip(axes, (r.source, r.lang, r.topic)))
        tokens[where[r.doc_id]] += r.n_tokens
    wanted = mixing.rake(tokens, [np.array(list(a.values())) for a in axes], mixing.BUDGET * tokens.sum())
    assert all(abs(r.probability - wanted[where[r.doc_id]] / tokens[where[r.doc_id]]) < 1e-9 for r in rows)
    expected, taken = sum(r.probability for r in rows), sum(r.sampled for r in rows)
    assert abs(taken - expected) < 4 * sum(r.probability * (1 - r.probability) for r in rows) ** 0.5
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in rows if r.sampled}


def test_a_large_source_gives_way_whatever_its_name(documents):
    """Sources nobody listed are raked: one of 80 % of all tokens comes down to the flattened share."""
    rows = [(i, "some words of a text " * 8, "en", "crawl.example" if i % 10 < 8 else f"site{i % 10}.example") for i in range(3000)]
    found = mixing.mixed(documents(rows), mixing.Mix(languages={"en": 1.0}, topics={"prose": 1.0}, budget=0.2)).collect()
    expected = Counter()
    for r in found:
        expected[r.source] += r.n_tokens * r.probability
    share = expected["crawl.example"] / sum(expected.values())
    assert abs(share - 0.8**0.5 / (0.8**0.5 + 2 * 0.1**0.5)) < 1e-6


def test_many_sources_and_other_topics(documents, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    rows = [(i, "word " * (1 + i % 7), "en", f"s{i % 9}") for i in range(300)] + [(1000 + i, "word", "en", mixing.OTHER) for i in range(9)]
    found = mixing.mixed(documents(rows), topic=lambda text: F.when(F.length(text) > 20, "long").otherwise("short")).collect()
    assert len(found) == 309 and {r.topic for r in found} == {"long", "short"} and all(0 <= r.probability <= 1 for r in found)
    given = mixing.Mix(sources={"s1": 0.9, mixing.OTHER: 0.1}, budget=0.1)
    taken = mixing.mixed(documents(rows), given).filter("source = 's1'").agg(F.sum(F.col("probability") * F.col("n_tokens"))).first()[0]
    assert taken > 0.8 * 0.1 * sum(r.n_tokens for r in found)


def test_edges(edge_documents, no_documents):
    rows = mixing.mixed(edge_documents).collect()
    assert len(rows) == edge_documents.count() and all(0 <= r.probability <= 1 for r in rows)
    assert {r.sampled for r in rows if r.doc_id == 7}.__len__() == 1
    assert mixing.mixed(no_documents).collect() == [] and mixing.sampled(no_documents).collect() == []
    assert mixing.sampled(edge_documents).columns == edge_documents.columns


def test_topics(spark):
    texts = ["a | b", "LOUD!! WORDS!!", "a### b", "Released under the MIT License.", "plain", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(mixing.topic_of(F.col("text")).alias("t"))
    assert [r.t for r in df.collect()] == ["table", "shouting", "markup", "license", "prose", "prose"]
