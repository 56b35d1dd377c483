"""Ring sharding against a walk around the ring, row by row."""

from __future__ import annotations

import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import ring


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def spark_hash(*values):
    seed = 42
    for value in values:
        if value is not None:
            data = value.encode() if isinstance(value, str) else struct.pack("<q", value)
            seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def walk(rows, shards, replicas, splits=16):
    """{(doc_id, crc, size): [(shard, slot)]} by giving every shard its own rows, then carrying the rest clockwise."""
    points = ring.ring_points(shards, replicas)
    arcs = defaultdict(list)
    for doc_id, crc, size in rows:
        cell = spark_hash(doc_id) % ring.CELLS
        arc = next((i for i, (at, _) in enumerate(points) if at >= cell), 0)
        part = spark_hash("part", doc_id, crc, size) % splits
        arcs[arc].append((part, (doc_id is not None, doc_id or 0), crc, size))
    room = {s: len(rows) // shards + (s < len(rows) % shards) for s in range(shards)}
    placed, over, found = Counter(), defaultdict(list), defaultdict(list)

    def put(row, shard):
        found[(row[1][1] if row[1][0] else None, row[2], row[3])].append((shard, placed[shard]))
        placed[shard] += 1

    for arc, (_, shard) in enumerate(points):
        for row in sorted(arcs[arc]):
            put(row, shard) if placed[shard] < room[shard] else over[arc].append(row)
    waiting = []
    for arc in [*range(len(points)), *range(len(points))]:
        waiting += over.pop(arc, [])
        while waiting and placed[points[arc][1]] < room[points[arc][1]]:
            put(waiting.pop(0), points[arc][1])
    return {key: sorted(value) for key, value in found.items()}


@pytest.mark.parametrize(("count", "shards", "replicas"), [(500, 7, 4), (13, 24, 8), (1, 3, 1), (300, 24, 64)])
def test_against_a_walk(documents, count, shards, replicas):
    rows = [(i * 37 if i % 11 else None, f"text {i % 50}") for i in range(count)] + [(5, "twice"), (5, "twice")]
    found = defaultdict(list)
    for r in ring.shard_documents(documents(rows), shards, replicas).collect():
        found[(r.doc_id, r.text_crc32, r.size)].append((r.shard, r.slot))
    wanted = walk([(i, zlib.crc32(t.encode()), len(t.encode()) + 8) for i, t in rows], shards, replicas)
    assert {k: sorted(v) for k, v in found.items()} == wanted


def test_counts_are_level_and_slots_have_no_gaps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = ring.shard_documents(docs).collect()
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
    assert len(found) == 1000 and set(by_shard) == set(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_most_rows_stay_at_home_and_most_stay_when_the_ring_grows(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before = {r.doc_id: r for r in ring.shard_documents(docs, 12, 64).collect()}
    after = {r.doc_id: r for r in ring.shard_documents(docs, 13, 64).collect()}
    assert sum(r.shard != r.home_shard for r in before.values()) < 0.12 * 20_000
    homes = [i for i in before if before[i].home_shard != after[i].home_shard]
    assert all(after[i].home_shard == 12 for i in homes)
    assert sum(before[i].shard != after[i].shard for i in before) < 0.3 * 20_000


def test_edges(edge_documents, no_documents):
    rows = ring.shard_documents(edge_documents, 4, 8).collect()
    assert len(rows) == edge_documents.count()
    sizes = {(r.doc_id, r.size, r.text_crc32) for r in rows}
    assert {(1, 8, 0), (2, 8, 0), (None, 8, 0)} <= sizes
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)
    assert ring.shard_documents(no_documents).collect() == []


def test_no_python_and_no_unbounded_window(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = ring.shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_repeated_id_is_numbered_by_several_tasks(documents):
    """Half of all rows have one id: they go to many parts, and still to shards of equal size."""
    rows = [(7, f"text {i}") for i in range(2000)] + [(i + 100, "other") for i in range(2000)]
    found = ring.shard_documents(documents(rows)).collect()
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(found) == 4000
    parts = {spark_hash("part", 7, r.text_crc32, r.size) % 16 for r in found if r.doc_id == 7}
    assert len(parts) == 16
