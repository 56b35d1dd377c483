"""Benchmark decontamination by winnowing.

Texts are cut into words. A window is ``window_words`` consecutive words of a benchmark item, or all its words if it has fewer; its
length names a class. For a window of n words, k = (n + 1) // 2 and of every n - k + 1 consecutive k-gram hashes the smallest
(the last of equals) is kept, so a span of n words or more that two texts share gives both of them a common kept hash within it. Kept hashes
of documents and items are joined on the hash; each hit carries the words around it and is extended to both sides, and a run of n equal words
is an occurrence. Word comparison is by 64-bit hash.

Documents drop hashes that miss a bit table of the benchmark's hashes before the join. The table grows with the number of those hashes, up to
``MOST_BITS`` (16 MB); a benchmark that fills it only makes the join larger.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_batches, known_rows, texts
from tidemark.session import materialise

WINDOW_WORDS = 13
SHARE = 20
LEAST_BITS, MOST_BITS = 1 << 22, 1 << 27
BITS_PER_GRAM = 64
_BREAKS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
# A-Z become a-z, whatever does not belong to a word becomes a blank, bytes beyond ASCII stay.
_TO_WORDS = bytes(0x20 if (b in _BREAKS and not 0x41 <= b <= 0x5A) else (b + 32 if 0x41 <= b <= 0x5A else b) for b in range(256))
_PAD = {"document": np.uint64(0), "item": np.uint64(1)}
_FOUND = "len int, gram long, at int, around binary"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


def word_hashes(text: bytes | None):
    found = words(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def _grams(hashes, k: int):
    """64-bit hashes of all runs of k words."""
    size = len(hashes) - k + 1
    mixed = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + size]
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def winnowed(hashes, length: int):
    """(positions, k-gram hashes) kept for windows of ``length`` words; nothing if the text is shorter."""
    k = (length + 1) // 2
    if len(hashes) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = _grams(hashes, k)
    span = length - k + 1
    views = np.lib.stride_tricks.sliding_window_view(grams, span)
    kept = np.unique(np.arange(len(views)) + span - 1 - np.argmin(views[:, ::-1], axis=1))
    return kept, grams[kept]


def _around(hashes, positions, length: int, side: str):
    """The words of every window that holds the k-gram at a position, padded at the ends of the text."""
    reach = length - (length + 1) // 2
    padded = np.concatenate((np.full(reach, _PAD[side]), hashes, np.full(reach, _PAD[side])))
    return np.lib.stride_tricks.sliding_window_view(padded, length + reach)[positions]


def _found(text, lengths, side: str, keep):
    """(word count, [(length, gram, position, surroundings)])"""
    hashes = word_hashes(text)
    found = []
    for length in lengths(len(hashes)):
        at, grams = winnowed(hashes, length)
        if len(at):
            chosen = keep(grams)
            at, grams = at[chosen], grams[chosen]
            around = _around(hashes, at, length, side) if len(at) else ()
            found += [
                {"len": length, "gram": g, "at": p, "around": a.tobytes()} for g, p, a in zip(grams.view(np.int64).tolist(), at.tolist(), around)
            ]
    return len(hashes), found


_FOUND_TYPE = pa.list_(pa.struct([("len", pa.int32()), ("gram", pa.int64()), ("at", pa.int32()), ("around", pa.binary())]))


def _item_rows(window_words: int):
    def rows(batches):
        for batch in batches:
            found = [_found(t, lambda n: [min(n, window_words)] if n else [], "item", lambda g: np.arange(len(g)))[1] for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, _FOUND_TYPE)], ["item_id", "found"])

    return rows


def _document_rows(lengths: list[int], table):
    """``table``: the bit table, as a broadcast variable."""

    def rows(batches):
        bits = np.frombuffer(table.value, np.uint8)
        first, number = TaskContext.get().partitionId() << 40, count()

        def keep(grams):
            place = (grams & np.uint64(8 * len(bits) - 1)).astype(np.int64)
            return np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)

        for batch in batches:
            found = [_found(text, lambda n: lengths, "document", keep) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first + next(number) for _ in found], pa.int64()),
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([hits for _, hits in found], _FOUND_TYPE),
                ],
                ["row", "doc_id", "text_key", "n_words", "found"],
            )

    return rows


def table_bits(grams: int) -> int:
    """Size of the bit table for a number of hashes, a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, grams * BITS_PER_GRAM) - 1).bit_length()))


def _bit_table(grams: DataFrame) -> bytes:
    """Gathered as at most one number for 64 bits."""
    grams = grams.select("gram").distinct()
    size = table_bits(grams.count())
    place = F.col("gram").bitwiseAND(F.lit(size - 1)).cast("int")
    word = grams.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, CAST(gram & 63 AS int))").alias("bit"))
    table = word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy()
    return bits.tobytes()


def _extended(batches):
    """Hits with both surroundings to occurrences: (row, low, high, around_id), words [low, high) of the document."""
    for batch in batches:
        lens = batch.column("len").to_numpy(zero_copy_only=False)
        out = []
        for length in np.unique(lens):
            chosen = np.flatnonzero(lens == length)
            reach, k = int(length) - (int(length) + 1) // 2, (int(length) + 1) // 2
            picked = batch.take(pa.array(chosen))
            ours, theirs = (
                np.frombuffer(b"".join(picked.column(c).to_pylist()), np.uint64).reshape(len(chosen), -1) for c in ("around", "item_around")
            )
            equal = ours == theirs
            inside = equal[:, reach : reach + k].all(axis=1)
            before = np.cumprod(equal[:, :reach][:, ::-1], axis=1).sum(axis=1)
            after = np.cumprod(equal[:, reach + k :], axis=1).sum(axis=1)
            good = inside & (before + k + after >= length)
            at = picked.column("at").to_numpy(zero_copy_only=False).astype(np.int64)
            row, around = (picked.column(c).to_numpy(zero_copy_only=False) for c in ("row", "around_id"))
            out.append((row[good], (at - before)[good], (at + k + after)[good], around[good]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["row", "low", "high", "around_id"])


def contamination(docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS, share: int = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key.

    A word inside an occurrence of a window is hit; contaminated means that at least one word in ``share`` is hit. Null
    and empty texts have no words, on either side. Items with equal ids count once; a null item_id has no place in the list, but its windows
    hit. Repeated rows of ``docs`` are judged each on its own. Only doc_id, text and item_id, text are read. Without items nothing is hit.
    """
    spark = docs.sparkSession
    rows = items.select(items["item_id"].alias("item_id"), items["text"].alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    item_rows = in_batches(rows, _item_rows(window_words), f"item_id {kind}, found array<struct<{_typed()}>>")
    marks = materialise(item_rows.select("item_id", F.inline("found")).withColumn("around_id", F.xxhash64("len", "around", "gram")), "marks")
    lengths = sorted(row.len for row in marks.select("len").distinct().collect())  # at most window_words
    table = spark.sparkContext.broadcast(_bit_table(marks))  # MOST_BITS / 8 bytes at most
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), F.xxhash64(docs["text"]).alias("text_key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, text_key long, n_words long, found array<struct<{_typed()}>>"
    read = materialise(in_batches(rows, _document_rows(lengths, table), schema), "documents")

    known = marks.select("len", "gram", F.col("around").alias("item_around"), "around_id").distinct()
    hits = read.select("row", F.inline("found")).join(known, ["len", "gram"])
    hits = hits.select("row", "len", "at", "around", "item_around", "around_id")
    spans = materialise(hits.mapInArrow(_extended, "row long, low long, high long, around_id long"), "spans")
    runs = F.transform(F.collect_set(F.struct("low", "high")), lambda s: F.sequence(s["low"], s["high"] - 1))
    covered = F.size(F.array_distinct(F.flatten(runs)))
    words_hit = spans.groupBy("row").agg(covered.cast("long").alias("n_hit"))
    named = spans.select("row", "around_id").distinct().join(marks.select("around_id", "item_id").distinct(), "around_id")
    found = named.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    result = read.select("row", "doc_id", "text_key", "n_words").join(words_hit.join(found, "row"), "row", "left")
    hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", none)
    return result.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated"),
        "text_key",
    )


def _typed() -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (field.split() for field in _FOUND.split(", ")))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept; a row is recognised by its doc_id and a hash of its text."""
    return known_rows(docs, contamination(docs, items).filter("contaminated"), "left_anti")
