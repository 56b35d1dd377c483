"""Reversible incremental line dedup: sharded cuckoo filters in front of exact reference-count tables.

``LineStore`` holds three tables. ``postings`` are the (line key, doc_id) pairs, ``refs`` count the documents of each key and
name the largest one, and ``filters`` hold the keys as cuckoo fingerprints, sharded by key. Inserting documents probes the filters with
their distinct keys: a miss is surely a new key and is appended without looking at the counts; only possible hits are
joined with them. Deleting documents takes their postings back, recounts the keys they held and removes keys nobody holds any more from
the filters, so that the store is as if they had never been there. All three are written to the shared folder at each step.

Each insert adds a segment to the filters of a shard. The counts of a key name the segment that holds its fingerprint, so that deleting it takes no
other key's. When shards have come to hold twice ``SHARD_KEYS`` keys, or ``SEGMENTS`` segments, the filters are built anew from the counts, in more
shards or as one segment.

A key is the 128-bit BLAKE2b digest of the normalised line, as two numbers. Everything that meets in one task is a shard of
distinct keys, about ``SHARD_KEYS`` of them; postings of a frequent line are only ever counted before the shuffle or joined.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_batches, texts
from tidemark.session import materialise

MIN_POINTS = 20
MIN_DOCS = 3
SHARD_KEYS = 250_000
SEGMENTS = 8
SLOTS = 4
LOAD = 0.85
KICKS = 500


def line_key(line: bytes) -> bytes | None:
    """Digest of the line without outer white space (\\x20 \\x09-\\x0D), A-Z in lower case; None if it is too short to count."""
    key = line.strip().lower()
    if len(key) < MIN_POINTS or (not key.isascii() and len(key.decode()) < MIN_POINTS):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def text_lines(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def _keys(batches):
    for batch in batches:
        keys, ids = [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            found = {key for key in map(line_key, text_lines(text)) if key}
            keys += found
            ids += [doc_id] * len(found)
        pairs = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(ids, pa.int64())], ["hi", "lo", "doc_id"])


def line_keys(docs: DataFrame) -> DataFrame:
    """Postings of ``docs``: hi, lo, doc_id; each key once per row. Lines of rows without doc_id are not counted."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).filter("doc_id IS NOT NULL")
    return in_batches(rows, _keys, "hi long, lo long, doc_id long")


# --- cuckoo filters ---


def _places(hi, lo, buckets: int):
    """Fingerprints (16 bits, never 0) and both buckets of keys; the second follows from the first and the fingerprint."""
    mark = ((lo >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16)
    mark[mark == 0] = 1
    first = (hi & np.uint64(buckets - 1)).astype(np.int64)
    return mark, first, _other(first, mark, buckets)


def _other(bucket, mark, buckets: int):
    mixed = (mark.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(3)
    return bucket ^ (mixed & np.uint64(buckets - 1)).astype(np.int64)


def build_filter(hi, lo):
    """Cuckoo table (buckets x SLOTS) with all keys, as large as needed: doubled if a key finds no slot."""
    buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(hi)) / (SLOTS * LOAD)))))
    while True:
        table = np.zeros((buckets, SLOTS), np.uint16)
        if _insert(table, *_places(hi, lo, buckets)):
            return table
        buckets *= 2


def _insert(table, mark, first, second) -> bool:
    waiting, at = np.arange(len(mark)), first.copy()
    for turn in range(4):  # in bulk: whoever finds a free slot in its first or second bucket
        order = np.argsort(at[waiting], kind="stable")
        waiting = waiting[order]
        here = at[waiting]
        rank = np.arange(len(here)) - np.searchsorted(here, here)
        free = SLOTS - (table[here] != 0).sum(axis=1)
        fits = rank < free
        for slot in range(SLOTS):  # the slots of a bucket fill from the left
            now = fits & ((SLOTS - free + rank) == slot)
            table[here[now], slot] = mark[waiting[now]]
        waiting = waiting[~fits]
        at[waiting] = np.where(turn % 2 == 0, second[waiting], first[waiting])
    chance = np.random.default_rng(1)
    for key in waiting.tolist():
        held, bucket = mark[key], int(first[key])
        for _ in range(KICKS):
            empty = np.flatnonzero(table[bucket] == 0)
            if len(empty):
                table[bucket, empty[0]] = held
                break
            slot = int(chance.integers(SLOTS))
            held, table[bucket, slot] = table[bucket, slot], held
            bucket = int(_other(np.int64(bucket), np.uint16(held), len(table)))
        else:
            return False
    return True


def probe(table, hi, lo):
    mark, first, second = _places(hi, lo, len(table))
    return (table[first] == mark[:, None]).any(axis=1) | (table[second] == mark[:, None]).any(axis=1)


def remove(table, hi, lo):
    """Take one fingerprint per key out of the table; returns which keys were found in it."""
    mark, first, second = _places(hi, lo, len(table))
    found = np.zeros(len(mark), bool)
    for i, (m, a, b) in enumerate(zip(mark, first, second)):
        for bucket in (a, b):
            slots = np.flatnonzero(table[bucket] == m)
            if len(slots):
                table[bucket, slots[0]] = 0
                found[i] = True
                break
    return found


def _arrays(group: pa.Table):
    return tuple(group[c].to_numpy().view(np.uint64) for c in ("hi", "lo"))


def _tables(group: pa.Table):
    return [np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy() for slots in group["slots"].to_pylist()]


def _built(group: pa.Table) -> pa.Table:
    table = build_filter(*_arrays(group))
    return pa.table({"shard": [group["shard"][0].as_py()], "step": [group["step"][0].as_py()], "slots": [table.tobytes()]}, _FILTER_TYPE)


def _probed(keys: pa.Table, filters: pa.Table) -> pa.Table:
    hi, lo = _arrays(keys)
    seen = np.zeros(len(hi), bool)
    for table in _tables(filters):
        seen |= probe(table, hi, lo)
    return keys.select(["shard", "hi", "lo", "n", "keeper"]).append_column("seen", pa.array(seen))


def _removed(filters: pa.Table, keys: pa.Table) -> pa.Table:
    hi, lo = _arrays(keys)
    own, out = keys["step"].to_numpy(), []
    for step, table in zip(filters["step"].to_pylist(), _tables(filters)):
        remove(table, hi[own == step], lo[own == step])
        out.append(table.tobytes())
    return pa.table({"shard": filters["shard"], "step": filters["step"], "slots": out}, _FILTER_TYPE)


_FILTER_TYPE = pa.schema([("shard", pa.int32()), ("step", pa.int32()), ("slots", pa.binary())])
_FILTERS = "shard int, step int, slots binary"


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("hi", "lo"), F.lit(shards)).cast("int")


@dataclass(frozen=True)
class LineStore:
    """Line keys of the documents inserted so far. Every method returns a new store."""

    shards: int = 0
    step: int = 0
    segments: int = 0
    postings: DataFrame | None = None
    refs: DataFrame | None = None
    filters: DataFrame | None = None

    def insert(self, postings: DataFrame) -> LineStore:
        """Add the ``line_keys`` of documents. Pairs that are known already change nothing."""
        if self.postings is not None:
            postings = postings.join(self.postings, ["hi", "lo", "doc_id"], "left_anti")
        added = materialise(postings.distinct(), "postings")
        counted = materialise(added.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")), "counted")
        shards = self.shards or max(1, -(-counted.count() // SHARD_KEYS))
        delta = counted.withColumn("shard", _shard(shards))
        step = F.lit(self.step).alias("step")
        if self.filters is None:
            refs = materialise(delta.select("shard", "hi", "lo", "n", "keeper", step), "refs")
            fresh = refs
        else:
            probed = delta.groupBy("shard").cogroup(self.filters.groupBy("shard"))
            probed = materialise(probed.applyInArrow(_probed, "shard int, hi long, lo long, n long, keeper long, seen boolean"), "probed")
            known = self.refs.select("hi", "lo", F.col("n").alias("old_n"), F.col("keeper").alias("old_keeper"), "step")
            # Possible hits meet the exact counts; one without counts was a false positive and is new as well.
            looked_up = materialise(probed.filter("seen").join(known, ["hi", "lo"], "left"), "looked-up")
            fresh = probed.filter("NOT seen").unionByName(looked_up.filter("old_n IS NULL").select(*probed.columns))
            fresh = fresh.select("shard", "hi", "lo", "n", "keeper", step)
            grown = looked_up.filter("old_n IS NOT NULL").select(
                "shard", "hi", "lo", (F.col("n") + F.col("old_n")).alias("n"), F.greatest("keeper", "old_keeper").alias("keeper"), "step"
            )
            untouched = self.refs.join(grown.select("hi", "lo"), ["hi", "lo"], "left_anti").select(*grown.columns)
            refs = materialise(untouched.unionByName(grown).unionByName(fresh), "refs")
        held = added if self.postings is None else self.postings.unionByName(added)
        store = replace(self, shards=shards, step=self.step + 1, segments=self.segments + 1, postings=held, refs=refs)
        keys = refs.count()
        if self.filters is not None and (keys > 2 * shards * SHARD_KEYS or store.segments > SEGMENTS):
            return store.rebuilt(max(shards, -(-keys // SHARD_KEYS)))
        segments = fresh.groupBy("shard").applyInArrow(_built, _FILTERS)
        filters = segments if self.filters is None else self.filters.unionByName(segments)
        return replace(store, filters=materialise(filters, "filters"))

    def rebuilt(self, shards: int) -> LineStore:
        """The same store with its filters made anew from the counts: one segment in each of ``shards`` shards."""
        refs = self.refs.select(_shard(shards).alias("shard"), "hi", "lo", "n", "keeper", F.lit(self.step).alias("step"))
        refs = materialise(refs, "refs")
        filters = materialise(refs.groupBy("shard").applyInArrow(_built, _FILTERS), "filters")
        return replace(self, shards=shards, step=self.step + 1, segments=1, refs=refs, filters=filters)

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """Take documents (a column doc_id) back out; unknown ids change nothing."""
        gone = doc_ids.select(F.col("doc_id").cast("long")).distinct()
        held = materialise(self.postings.join(gone, "doc_id", "left_anti").select("hi", "lo", "doc_id"), "postings")
        touched = materialise(self.postings.join(gone, "doc_id", "left_semi").select("hi", "lo").distinct(), "touched")
        recounted = held.join(touched, ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        known = materialise(self.refs.join(touched, ["hi", "lo"], "left_semi").select("shard", "hi", "lo", "step"), "known")
        recounted = materialise(known.join(recounted, ["hi", "lo"]).select("shard", "hi", "lo", "n", "keeper", "step"), "recounted")
        lost = known.join(recounted, ["hi", "lo"], "left_anti").select("shard", "hi", "lo", "step")
        refs = self.refs.join(touched, ["hi", "lo"], "left_anti").unionByName(recounted)
        filters = self.filters.groupBy("shard").cogroup(lost.groupBy("shard")).applyInArrow(_removed, _FILTERS)
        return replace(self, step=self.step + 1, postings=held, refs=materialise(refs, "refs"), filters=materialise(filters, "filters"))

    def dropped(self, postings: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc_id, drops): per document the keys whose lines go, since at least ``min_docs`` documents hold them and a larger id keeps them."""
        frequent = self.refs.filter(F.col("n") >= min_docs).select("hi", "lo", "keeper")
        gone = postings.join(frequent, ["hi", "lo"]).filter("doc_id < keeper")
        return gone.groupBy("doc_id").agg(F.collect_set(F.struct("hi", "lo")).alias("drops"))


def _kept(batches):
    for batch in batches:
        out = []
        for text, drops in zip(texts(batch), batch.column("drops").to_pylist()):
            lines = text_lines(text)
            kept = lines
            if drops:
                gone = {np.array([d["hi"], d["lo"]], np.int64).tobytes() for d in drops}
                kept = [line for line in lines if line_key(line) not in gone]
            out.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
        columns = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_lines", "n_dropped", "kept"])


def cleaned(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept (the other lines, joined by a newline).

    A null or empty text is one empty line. A row without doc_id neither counts nor loses lines. Rows with equal doc_id are one document:
    a line that any of them holds counts once, and all of them lose or keep it.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    joined = rows.join(drops, "doc_id", "left").select("doc_id", "text", "drops")
    return in_batches(joined, _kept, "doc_id long, n_lines long, n_dropped long, kept string")


def dedup_lines(docs: DataFrame, batches: int = 2, min_docs: int = MIN_DOCS) -> DataFrame:
    """Load ``docs`` into a store in ``batches`` increments and clean all of them against it. Columns as ``cleaned``.

    Only doc_id and text are read. An empty table gives no rows.
    """
    postings = materialise(line_keys(docs), "line-keys")
    store = LineStore()
    for batch in range(batches):
        store = store.insert(postings.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == batch))
    return cleaned(docs, store.dropped(postings.distinct(), min_docs))
