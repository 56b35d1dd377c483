"""Base rules and cross-document line frequency against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import rules

SPACE = " \t\n\x0b\f\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(found, length=8):
    windows = [tuple(found[i : i + length]) for i in range(len(found) - length + 1)]
    often = Counter(windows)
    return len({spot for i, window in enumerate(windows) if often[window] > 1 for spot in range(i, i + length)})


def normal(line):
    line = re.sub(r"[\x20\x09-\x0D]+", " ", line.strip(SPACE))
    return "".join(c.lower() if c.isascii() else c for c in line)


def judged(rows, limits=rules.Limits()):
    """Expected rows from (doc_id, text, lang, source) tuples."""
    holders, hosts = defaultdict(set), defaultdict(set)
    for _, text, _, host in rows:
        hosts[host].add(text or "")
        for line in (text or "").split("\n"):
            if words(line):
                holders[host, normal(line)].add(text)
    frequent = {key for key, texts in holders.items() if len(texts) > limits.line_docs and len(texts) * 100 > len(hosts[key[0]]) * limits.line_percent}
    out = []
    for doc_id, text, _, host in rows:
        found, lines = words(text), [line for line in (text or "").split("\n") if words(line)]
        removed = sum(len(words(line)) for line in lines if (host, normal(line)) in frequent)
        n_repeat = repeated(found)
        failed = len(found) < limits.min_words or 100 * n_repeat > limits.repeat_percent * len(found)
        kept = not failed and 100 * (len(found) - removed) >= limits.left_percent * len(found)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        out.append((doc_id, len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), n_repeat, removed, failed, kept))
    return out


def listed(df):
    return Counter(tuple(row) for row in df.collect())


def corpus(hosts=("a", "b", None), count=30):
    rows = []
    for h, host in enumerate(hosts):
        for i in range(count):
            own = " ".join(f"w{h}-{i}-{j}" for j in range(10 + i))
            menu = "  Home | News\t&  Page 9 " if i % 2 else "home | news & page 9"
            long_menu = " ".join(f"menu{j}" for j in range(18))
            lines = [own] + [menu] * (i % 3 > 0) + [long_menu] * (i % 4 == 0) + ["", " \t"] + [own] * (i % 5 == 0)
            rows.append((h * 1000 + i, "\n".join(lines), "en", host))
    return rows


def test_against_plain_python(documents, edge_documents):
    rows = corpus() + [(1, corpus()[1][1], "en", "a")] * 3
    assert listed(rules.judged(documents(rows))) == Counter(judged(rows))
    edges = [(r.doc_id, r.text, r.lang, r.source) for r in edge_documents.collect()]
    assert listed(rules.judged(edge_documents)) == Counter(judged(edges))


@pytest.mark.parametrize("limits", [rules.Limits(2, 10, 5, 10, 80), rules.Limits(0, 0, 0, 100, 1)])
def test_limits(documents, limits):
    rows = corpus(count=12)
    assert listed(rules.judged(documents(rows), limits=limits)) == Counter(judged(rows, limits))


def test_copies_count_as_one_document(documents):
    """Thousands of copies of a document do not make its lines frequent; different documents that share a line do."""
    text = " ".join(f"word{i}" for i in range(30))
    copies = [(i, text, "en", "a") for i in range(200)]
    shared = [(1000 + i, f"{text} and\n" + " ".join(f"own{i}-{j}" for j in range(29)), "en", "b") for i in range(10)]
    found = {row.doc_id: row for row in rules.judged(documents(copies + shared)).collect()}
    assert all(found[i].kept and not found[i].n_removed_words for i in range(200))
    assert all(not found[1000 + i].kept and found[1000 + i].n_removed_words == 31 for i in range(10))


@pytest.mark.parametrize("length", [0, 1, 7, 8, 9, 40])
def test_repeated_windows(spark, length):
    found = [f"x{i % 9}" for i in range(length)] + [f"y{i}" for i in range(length)] + [f"x{i % 9}" for i in range(length)]
    df = spark.createDataFrame([(" ".join(found),)], "text string")
    assert df.select(rules.repeat_words(rules.words_of(F.col("text")))).first()[0] == repeated(found)


def test_long_text(documents):
    text = " ".join(f"w{i % 70_000}" for i in range(150_000))
    row = rules.judged(documents([(1, text)])).first()
    assert (row.n_words, row.n_repeat_words, row.base_failed) == (150_000, 150_000, True)


def test_empty_table(no_documents):
    assert rules.judged(no_documents).count() == 0
    assert rules.without_frequent_lines(no_documents).count() == 0


def test_no_python_workers(documents):
    plan = rules.judged(documents(corpus(count=3)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Scala" not in plan


def test_cleaned_texts(documents):
    """Removed lines leave the kept texts, and nothing else changes; odd column names are kept."""
    rows = corpus()
    docs = documents(rows).withColumn("a.b", F.lit(1)).withColumn("c`d", F.lit(2)).withColumn("__found", F.lit(3))
    found = {row.doc_id: row for row in rules.without_frequent_lines(docs).collect()}
    wanted = {row[0] for row in judged(rows) if row[-1]}
    assert set(found) == wanted
    texts = {row[0]: row[1] for row in rows}
    for doc_id, row in found.items():
        lines = texts[doc_id].split("\n")
        assert row.text == "\n".join(line for line in lines if not normal(line).startswith(("home", "menu")))
        assert (row["a.b"], row["c`d"], row["__found"]) == (1, 2, 3)
