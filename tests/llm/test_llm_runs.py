"""Runs of words against all periods tried one by one."""

from __future__ import annotations

import random
import zlib

import pytest

from tidemark.llm import runs


def all_runs(symbols, least_length=6, least_times=4):
    found, n = {}, len(symbols)
    for period in range(1, n // 2 + 1):
        i = 0
        while i < n - period:
            begin = i
            while i < n - period and symbols[i] == symbols[i + period]:
                i += 1
            length = i - begin + period
            if i > begin and length >= max(least_length, least_times * period):
                found.setdefault((begin, length), period)
            i += i == begin
    return sorted((begin, period, length) for (begin, length), period in found.items())


def random_text(rng, longest=60):
    n, letters = rng.randint(0, longest), rng.randint(1, 4)
    text = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, 9)
        text = [text[i] if i < a else text[min(n - 1, a + (i - a) % p)] for i in range(n)]
    return runs.numbered(text)


@pytest.mark.parametrize(("length", "times"), [(6, 4), (2, 2), (1, 3)])
def test_random_texts(length, times):
    rng = random.Random(5)
    for _ in range(400):
        texts = [random_text(rng) for _ in range(rng.randint(1, 5))]
        owner, start, size, period = runs.find_runs(texts, length, times)
        for d, text in enumerate(texts):
            own = owner == d
            assert list(zip(start[own].tolist(), period[own].tolist(), size[own].tolist())) == all_runs(text, length, times)


def test_extensions():
    """Constant-time answers from the tour against comparing symbols."""
    rng = random.Random(3)
    text = [rng.randrange(2) for _ in range(300)] + [0] * 50
    arrivals, came = runs.euler_tour([*text, 2], 3)
    minimum = runs.RangeMinimum(came)
    pairs = [(rng.randrange(350), rng.randrange(350)) for _ in range(2000)]
    pairs = [(i, j) for i, j in pairs if i != j]
    found = runs._extensions(arrivals, minimum, *map(list, zip(*pairs)))
    for (i, j), size in zip(pairs, found):
        wanted = next((k for k in range(350) if max(i, j) + k >= 350 or text[i + k] != text[j + k]), 350)
        assert size == wanted
    order = sorted(range(350), key=lambda i: [*text[i:], 2])
    assert order == sorted(range(350), key=lambda i: arrivals[i])


def test_a_long_run():
    _, start, length, period = runs.find_runs([[0] * 30_000, [i % 7 for i in range(20_000)]])
    assert list(zip(start, length, period)) == [(0, 30_000, 1), (0, 20_000, 7)]


def expected(doc_id, text, tails):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if tails and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]
    found = all_runs(words)
    gone = {i for start, period, length in found for i in range(start + period, start + length)}
    return n, [(start, length, period) for start, period, length in found], b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


@pytest.mark.parametrize("tails", [False, True])
def test_documents(documents, edge_documents, tails):
    rng = random.Random(8)
    rows = [(i, " ".join(f"ü{s}" for s in random_text(rng, 200))) for i in range(120)]
    for docs in (documents(rows), edge_documents.filter("length(text) < 1000 or text is null")):
        given = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
        found = runs.word_runs(docs, repeat_tails=tails).collect()
        got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found), key=str)
        assert got == sorted(((doc_id, *expected(doc_id, text, tails)) for doc_id, text in given), key=str)


def test_long_text_and_empty_table(edge_documents, no_documents):
    found = {r.doc_id: r for r in runs.word_runs(edge_documents).filter("doc_id = 4").collect()}
    assert [tuple(x) for x in found[4].runs] == [(0, 30_000, 1)] and found[4].collapsed == "word end."
    assert runs.word_runs(no_documents).count() == 0


def test_a_run_has_two_periods(documents):
    with pytest.raises(ValueError):
        runs.word_runs(documents([(1, "a a a")]), least_times=1)
