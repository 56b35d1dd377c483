"""Near-duplicate documents by SimHash, found with one-wildcard segment variants.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that differ in at most four bits differ in at most
one bit of some segment, so they agree on that segment with this bit left out. Each distinct fingerprint is indexed under its
64 variants (a position, and the other bits of the position's segment); fingerprints that share a variant are compared.

A variant that many fingerprints share is not expanded into pairs. Its members are searched breadth-first, which needs the
distances from each reached member to the members not reached yet, and gives one link per member. Variants with more
than ``bucket_rows`` fingerprints are cut into blocks, and every two blocks are searched together in a group of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, in_batches, known_rows, quoted, texts
from tidemark.llm.components import components
from tidemark.session import materialise

SEGMENTS = ((0, 21), (21, 42), (42, 64))
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Fingerprints of one variant that one task holds at a time (8 bytes each).
BUCKET_ROWS = 1_000_000
# One fingerprint in so many is looked at to find variants beyond that size.
HEAVY_SAMPLE = 64
PART = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles; 0 without words."""
    words = text.lower().split() if text else []  # bytes: A-Z only, and white space is \\x20 \\x09-\\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(words)) - 1
    ends = ends[span:].tolist()
    starts = starts[: len(ends)].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, len(ends), PART):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[low : low + PART], ends[low : low + PART])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(ends), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        found = np.array([fingerprint(text) for text in texts(batch)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("text_key"), pa.array(found)], ["doc_id", "text_key", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp) per row; text_key is a hash of the whole text."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), F.xxhash64(docs["text"]).alias("text_key"))
    return in_batches(rows, _fingerprints, "doc_id long, text_key long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """Each ``fp`` under its 64 one-wildcard variants: ``key`` holds the wildcard's position and the other bits of its segment."""
    places = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place")
    start = F.when(F.col("place") < 21, 0).when(F.col("place") < 42, 21).otherwise(42)
    mask = F.when(F.col("place") < 42, (1 << 21) - 1).otherwise((1 << 22) - 1)
    spread = fps.select("fp", places).select("fp", "place", start.alias("start"), mask.alias("mask"))
    key = F.expr("shiftleft(place, 22) | (CAST(shiftrightunsigned(fp, start) & CAST(mask AS bigint) AS int) & ~shiftleft(1, place - start))")
    return spread.select(key.alias("key"), "fp")


def _linked(one, others, place: int, max_bits: int):
    """Which of ``others`` lie within ``max_bits`` of ``one`` and are to be linked at this variant: a pair with no differing bit in
    the segment shares all its variants and is taken at the first one; so every pair is taken once per segment at most."""
    low, high = next(s for s in SEGMENTS if s[0] <= place < s[1])
    differ = np.bitwise_xor(others, one)
    near = np.bitwise_count(differ) <= max_bits
    if place > low:
        near &= (differ >> np.uint64(place)) & np.uint64(1) == 1
    return near


def _stars(group, place: int, max_bits: int):
    """(member, root) for the members of one variant that are linked, directly or through each other."""
    members, roots, left = [], [], group
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            near = _linked(frontier.pop(), left, place, max_bits)
            if near.any():
                reached = left[near]
                left = left[~near]
                members.append(reached)
                roots.append(np.full(len(reached), root, np.uint64))
                frontier.extend(reached)
    return members, roots


def _variant_links(max_bits: int):
    def search(batches):
        held = []

        def links(arrays):
            keys, blocks, fps = (np.concatenate([a[i] for a in arrays]) for i in range(3))
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(blocks) != 0)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
            members, roots = [], []
            for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                more = _stars(np.unique(fps[a:b]), int(keys[a]) >> 22, max_bits)
                members += more[0]
                roots += more[1]
            if members:
                columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (members, roots)]
                yield pa.RecordBatch.from_arrays(columns, ["member", "root"])

        for batch in batches:
            arrays = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            arrays = (arrays[0], arrays[1], arrays[2].view(np.uint64))
            if not len(arrays[0]):
                continue
            # The last group of a batch may go on in the next one.
            other = np.flatnonzero((arrays[0] != arrays[0][-1]) | (arrays[1] != arrays[1][-1]))
            if len(other):
                last = other[-1] + 1
                yield from links([*held, tuple(a[:last] for a in arrays)])
                held = [tuple(a[last:] for a in arrays)]
            elif held and (held[-1][0][-1], held[-1][1][-1]) != (arrays[0][0], arrays[1][0]):
                yield from links(held)
                held = [arrays]
            else:
                held.append(arrays)
        if held:
            yield from links(held)

    return search


def _in_blocks(indexed: DataFrame, fps: DataFrame, bucket_rows: int, sample: int) -> DataFrame:
    """(key, block, fp): heavy variants are cut into blocks, and each fingerprint joins every pair that its block is part of."""
    chosen = variants(fps.filter(F.pmod(F.xxhash64(F.lit("sample"), "fp"), F.lit(sample)) == 0))
    heavy = chosen.groupBy("key").agg(F.count("*").alias("seen")).filter(F.col("seen") * sample > bucket_rows)
    heavy = heavy.select("key", F.ceil(2 * F.col("seen") * sample / F.lit(bucket_rows)).cast("int").alias("blocks"))
    heavy = materialise(heavy, "heavy")  # mostly empty, and then broadcast by its size
    marked = indexed.join(heavy, "key", "left").withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int"))
    pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda other: F.least(other, "own") * F.col("blocks") + F.greatest(other, "own"),
        )
    )
    return marked.select("key", F.explode(pairs).alias("block"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS, sample: int = HEAVY_SAMPLE) -> DataFrame:
    """(member, root) between distinct fingerprints ``fp``: whatever is linked through steps of at most ``max_bits`` differing
    bits is linked here too. ``max_bits`` may be 0 to 5 (three segments)."""
    if not 0 <= max_bits <= 5:
        raise ValueError("three segments find at most five differing bits")
    rows = _in_blocks(variants(fps), fps, bucket_rows, sample)
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block")
    return rows.mapInArrow(_variant_links(max_bits), "member long, root long")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS, sample: int = HEAVY_SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), text_key, fp, root.

    Null and empty texts, and texts without words, have fingerprint 0 and are linked like any other. A row without doc_id
    is linked too, but gives no name: component_id is null only if no row of the component has an id. Repeated rows stay. Only
    doc_id and text are read. An empty table gives no rows.
    """
    rows = materialise(fingerprints(docs), "fingerprints")
    groups = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "groups")
    found = components(links(groups.select("fp"), max_bits, bucket_rows, sample), "member", "root")
    rooted = groups.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(names, "root")
    joined = rows.join(named, "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_key", "fp", "root")


def representatives(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (rows without id last), then the smallest text hash.

    All columns are kept; of rows equal in doc_id and text one stays.
    """
    order = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("doc_id"), F.col("text_key").alias("text_key"))
    # Decided on ids and hashes; texts are read once more, and move only if they are repeated, or if more rows go than can be broadcast.
    rows = materialise(near_duplicates(docs, max_bits).groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("copies")), "members")
    chosen = materialise(rows.groupBy("root").agg(F.min(order).alias("one"), F.min_by("copies", order).alias("copies")), "chosen")
    first = chosen.select("root", F.col("one.doc_id").alias("first_id"), F.col("one.text_key").alias("first_key"), "copies")
    named = rows.select("root", "doc_id", "text_key").join(first.drop("copies"), "root")
    others = named.filter(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))))
    repeated = materialise(first.filter("copies > 1").select(F.col("first_id").alias("doc_id"), F.col("first_key").alias("text_key")), "repeated")
    if repeated.isEmpty():
        return known_rows(docs, others, "left_anti")
    text_key, copy = free_name(docs, "text_key"), free_name(docs, "copy")
    same = Window.partitionBy("doc_id", text_key).orderBy(F.lit(0))
    copies = known_rows(docs, repeated, "left_semi").withColumn(text_key, F.xxhash64(docs["text"])).withColumn(copy, F.row_number().over(same))
    once = copies.filter(F.col(copy) == 1).select(*map(quoted, docs.columns))
    return known_rows(docs, others.select("doc_id", "text_key").unionByName(repeated), "left_anti").unionByName(once)
