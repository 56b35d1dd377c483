"""SimHash groups against all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import common, simhash
from tidemark.llm.components import components


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    spans = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, bits):
    """{fingerprint: smallest one reachable}"""
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {f: top(f) for f in fps}


def fingerprints(seed, count):
    chance = random.Random(seed)
    fps = [chance.getrandbits(64) for _ in range(count)]
    for base in fps[:12]:
        for _ in range(25):  # clusters and chains around a few of them
            bits = chance.sample(range(64), chance.randint(1, 6))
            fps.append(base ^ sum(1 << b for b in bits))
    return [0, (1 << 64) - 1, 3, *fps]


@pytest.mark.parametrize(("bits", "bucket_rows"), [(4, simhash.BUCKET_ROWS), (4, 8), (2, 16), (0, 100)])
def test_links_connect_what_all_pairs_connect(spark, bits, bucket_rows):
    fps = fingerprints(bits, 300)
    signed = np.array(sorted(set(fps)), np.uint64).view(np.int64)
    df = spark.createDataFrame([(int(f),) for f in signed], "fp long")
    found = simhash.links(df, bits, bucket_rows, sample=1).collect()
    unsigned = lambda x: x % (1 << 64)
    got = {f: f for f in map(unsigned, signed.tolist())}

    def top(x):
        while got[x] != x:
            x = got[x]
        return x

    for r in found:
        x, y = top(unsigned(r.member)), top(unsigned(r.root))
        got[max(x, y)] = min(x, y)
    assert {f: top(f) for f in got} == groups(fps, bits)


def test_a_dense_group_gives_one_link_a_member(spark):
    chance = random.Random(5)
    fps = {sum(1 << b for b in chance.sample(range(64), 2)) for _ in range(600)}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    assert simhash.links(df).count() < 40 * len(fps)


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    top = groups(fps.values(), 4)
    smallest = defaultdict(lambda: 1 << 62)
    for i, f in fps.items():
        smallest[top[f]] = min(smallest[top[f]], i)
    wanted = {(i, format(f, "016x"), smallest[top[f]]) for i, f in fps.items()}
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert {tuple(r) for r in got} == wanted and len(got) == len(rows)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PART", 64)
    assert simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)


def test_edges(edge_documents, no_documents):
    rows = simhash.near_duplicates(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert by_id[1][0].fingerprint == "0" * 16 and by_id[2][0].component_id == 1 and by_id[3][0].component_id == 1
    assert by_id[6][0].component_id == 5 and len(by_id[7]) == 2
    assert simhash.near_duplicates(no_documents).collect() == []


def test_one_row_of_each_group_stays(edge_documents):
    kept = simhash.representatives(edge_documents)
    assert kept.columns == edge_documents.columns
    rows = simhash.near_duplicates(edge_documents).collect()
    assert kept.count() == len({r.root for r in rows})
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 1 and 5 in ids and 6 not in ids and 1 in ids and 2 not in ids


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    df = spark.createDataFrame([*chain, *star, (5, 5), (None, 3), (2000, 1040)], "a long, b long")
    found = {r.node: r.component for r in components(df, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}, 2000: 1000}
    assert components(df.filter(F.lit(False)), "a", "b").collect() == []


@pytest.mark.parametrize("rows", [0, 1_000_000])
def test_representatives_by_either_join(documents, monkeypatch, rows):
    """One row of each group stays, repeated rows included, whether what goes is broadcast or not."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    texts = [f"text {i} of several words that differ from one another {i * i}" for i in range(12)]
    given = [(i, texts[i % 12]) for i in range(30)] + [(0, texts[0])] * 3 + [(3, texts[3])] + [(None, texts[5])] * 2 + [(40, None), (40, None), (41, "")]
    kept = sorted((r.doc_id, r.text) for r in simhash.representatives(documents(given), 0).collect())
    assert kept == sorted([*((i, texts[i]) for i in range(12)), (40, None)])
