"""Ranked lexical search over a length-stratified index.

The score of a term in a document depends on the document only through its term frequency tf and its integer length normaliser m. Documents of
equal m form a stratum. The index stores strata in blocks: the block's documents, its distinct terms, and for each term its postings grouped by tf,
the largest first. So an impact is computed once per term and tf of a block, whatever the number of postings, and the first group of a
term has its largest impact in the block. The sum of those is a bound on the scores that an item can find there.

Index: one job counts the terms of each whole text, one deals documents to strata and packs them. A stratum that holds more than a small share of all
postings is dealt to several parts, so equal lengths (or copies) do not meet in one task. Blocks hold a bounded number of postings, or one document.

Search: the items' terms travel to the blocks, in broadcasts of at most ``ITEM_BYTES``. A first job reads the terms of all blocks for the document
frequencies. A second one bounds every block for every item, and scores in each task the blocks with the best bounds. Their tenth-best scores
are floors for the third job, which visits in each task the other blocks by falling bound while the bound reaches the item's floor. A bound that equals
the floor is visited, as a smaller doc_id may win. So the result is exact.

Terms are compared by 64-bit hash.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_batches, texts
from tidemark.session import materialise

TOP = 10
BLOCK_POSTINGS = 1 << 18
HELD_BYTES = 16 << 20  # of blocks that a task orders by bound before it visits them
SEEDS = 1  # blocks per item that each portion of a task scores in the first round
ITEM_BYTES = 32 << 20
PART_BYTES = 64 << 20
PARTS = (256, 65_536)  # parts that the strata are dealt to: at least and at most
_BREAKS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
# A-Z become a-z, whatever does not belong to a term becomes a blank, bytes beyond ASCII stay.
_TO_TERMS = bytes(0x20 if b in _BREAKS else (b + 32 if 0x41 <= b <= 0x5A else b) for b in range(256))
_COUNTED = "doc_id long, n long, terms binary, tfs binary"
_BLOCKS = "m long, ids binary, named binary, terms binary, groups binary, group_tfs binary, group_sizes binary, docs binary"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_TERMS).split() if text else []


def counted_terms(text: bytes | None):
    """(n, term hashes ascending, tf of each)"""
    found = terms_of(text)
    counts: dict[bytes, int] = {}
    for term in found:
        counts[term] = counts.get(term, 0) + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
    tfs = np.fromiter(counts.values(), np.int32, len(counts))
    order = np.argsort(hashes, kind="stable")
    return len(found), hashes[order], tfs[order]


def _counted(batches):
    for batch in batches:
        for low in range(0, batch.num_rows, 4096):
            part = batch.slice(low, 4096)
            rows = [counted_terms(text) for text in texts(part)]
            columns = [pa.array([n for n, _, _ in rows], pa.int64()), *(pa.array([row[i].tobytes() for row in rows], pa.binary()) for i in (1, 2))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n", "terms", "tfs"])


def normaliser(n, documents: int, terms: int):
    """The integer m of a document of ``n`` terms among ``documents`` documents with ``terms`` terms in all."""
    return 25 + (75 * n * documents) // terms


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def place_type(documents: int):
    """Of the places of documents in a block."""
    return np.uint16 if documents <= 1 << 16 else np.uint32


def pack_block(m: int, ids: list, hashes: list, tfs: list) -> dict:
    """Postings of the documents of one stratum, by term and falling tf."""
    doc = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(x) for x in hashes])
    term, tf = np.concatenate(hashes), np.concatenate(tfs)
    order = np.lexsort((doc, -tf, term))
    doc, term, tf = doc[order], term[order], tf[order]
    new_term = np.concatenate(([True], term[1:] != term[:-1]))
    new_group = new_term | np.concatenate(([True], tf[1:] != tf[:-1]))
    heads = np.flatnonzero(new_group)
    return {
        "m": m,
        "ids": np.array([x or 0 for x in ids], np.int64).tobytes(),
        "named": np.array([x is not None for x in ids], np.uint8).tobytes(),
        "terms": term[new_term].tobytes(),
        "groups": np.diff(np.append(np.flatnonzero(new_term[heads]), len(heads))).astype(np.int32).tobytes(),
        "group_tfs": tf[heads].astype(np.int32).tobytes(),
        "group_sizes": np.diff(np.append(heads, len(term))).astype(np.int32).tobytes(),
        "docs": doc.astype(place_type(len(ids))).tobytes(),
    }


_BLOCK_TYPES = pa.schema([("m", pa.int64()), *((name, pa.binary()) for name in ("ids", "named", "terms", "groups", "group_tfs", "group_sizes", "docs"))])


def _packed(postings: int):
    """Blocks from rows (m, doc_id, terms, tfs) in the order of m."""

    def rows(batches):
        held: list[tuple] = []
        m, size = None, 0

        def block():
            return pa.RecordBatch.from_pylist([pack_block(m, *(list(x) for x in zip(*held)))], _BLOCK_TYPES)

        for batch in batches:
            for stratum, doc_id, terms, tfs in zip(*(batch.column(name).to_pylist() for name in ("m", "doc_id", "terms", "tfs"))):
                more = len(terms) // 8
                if held and (stratum != m or size + more > postings):
                    yield block()
                    held, size = [], 0
                held.append((doc_id, np.frombuffer(terms, np.int64), np.frombuffer(tfs, np.int32)))
                m, size = stratum, size + more
        if held:
            yield block()

    return rows


class Index:
    """A length-stratified index: ``blocks`` (written, to be read again and again) and the number of documents with a term."""

    def __init__(self, blocks: DataFrame | None, documents: int):
        self.blocks = blocks
        self.documents = documents


def build_index(docs: DataFrame, block_postings: int = BLOCK_POSTINGS) -> Index:
    """Index every row of ``docs`` (doc_id and text are read). Rows without a term, null texts included, have no place in it."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    counted = materialise(in_batches(rows, _counted, _COUNTED).filter("n > 0"), "counted")
    documents, terms, size = counted.agg(F.count("*"), F.sum("n"), F.sum(F.length("terms"))).first()
    if not documents:
        return Index(None, 0)
    m = (F.lit(25) + F.expr(f"(75 * n * {documents}L) div {terms}L")).alias("m")
    strata = counted.select(m, F.length("terms").alias("size")).groupBy("m").agg(F.sum("size").alias("size"))
    parts = max(PARTS[0], min(PARTS[1], size // PART_BYTES))
    # At most ``parts`` strata hold more than one part in ``parts`` of all postings.
    large = strata.filter(F.col("size") * parts > size).select("m", F.ceil(F.col("size") * parts / size).cast("int").alias("split"))
    dealt = counted.select(m, "doc_id", "n", "terms", "tfs").join(F.broadcast(large), "m", "left")
    own = F.pmod(F.xxhash64("doc_id", "terms"), F.coalesce("split", F.lit(1)))
    dealt = dealt.withColumn("part", own).repartition("m", "part").sortWithinPartitions("m", "part").select("m", "doc_id", "terms", "tfs")
    return Index(materialise(in_batches(dealt, _packed(block_postings), _BLOCKS), "blocks"), documents)


class Items:
    """Some items as plain arrays: ``terms`` (distinct hashes, ascending), and per item its terms (as places in ``terms``) with their counts."""

    def __init__(self, numbers, terms, places, repeats, bounds):
        self.numbers, self.terms, self.places, self.repeats, self.bounds = numbers, terms, places, repeats, bounds

    @classmethod
    def of(cls, rows):
        """``rows``: (number, term hashes, counts)."""
        terms = np.unique(np.concatenate([np.frombuffer(r[1], np.int64) for r in rows]))
        places = np.concatenate([np.searchsorted(terms, np.frombuffer(r[1], np.int64)) for r in rows])
        repeats = np.concatenate([np.frombuffer(r[2], np.int32) for r in rows]).astype(np.int64)
        return cls(np.array([r[0] for r in rows], np.int64), terms, places, repeats, np.cumsum([0, *(len(r[1]) // 8 for r in rows)]))

    def plain(self) -> tuple:
        return self.numbers, self.terms, self.places, self.repeats, self.bounds


class _Block:
    """The part of a block that some items' terms touch."""

    def __init__(self, row: dict, items: Items, weights):
        self.ids, self.named = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["named"], np.uint8)
        terms = np.frombuffer(row["terms"], np.int64)
        at = np.minimum(np.searchsorted(terms, items.terms), len(terms) - 1)
        asked = np.flatnonzero(terms[at] == items.terms)  # places in items.terms
        groups = np.frombuffer(row["groups"], np.int32).astype(np.int64)
        sizes = np.frombuffer(row["group_sizes"], np.int32).astype(np.int64)
        first_group = np.concatenate(([0], np.cumsum(groups)))
        first_doc = np.concatenate(([0], np.cumsum(sizes)))
        here = at[asked]
        chosen = _ranges(first_group[here], groups[here])
        tfs = np.frombuffer(row["group_tfs"], np.int32)[chosen].astype(np.int64)
        owners = np.repeat(asked, groups[here])
        impacts = weights[owners] * impact(tfs, np.int64(row["m"]))  # once per term and tf
        self.starts = np.zeros(len(items.terms) + 1, np.int64)
        self.starts[asked + 1] = first_doc[first_group[here + 1]] - first_doc[first_group[here]]
        self.starts = np.cumsum(self.starts)
        self.docs = np.frombuffer(row["docs"], place_type(len(self.ids)))[_ranges(first_doc[chosen], sizes[chosen])]
        self.impacts = np.repeat(impacts, sizes[chosen])
        best = np.zeros(len(items.terms), np.int64)
        best[asked] = impacts[np.concatenate(([0], np.cumsum(groups[here])[:-1]))] if len(asked) else 0
        summed = np.concatenate(([0], np.cumsum(best[items.places] * items.repeats)))
        self.bound = summed[items.bounds[1:]] - summed[items.bounds[:-1]]

    def best(self, items: Items, item: int, top: int, floor: int):
        """(scores, document places) of the ``top`` documents for an item that reach the floor."""
        low, high = items.bounds[item], items.bounds[item + 1]
        places, repeats = items.places[low:high], items.repeats[low:high]
        begin, size = self.starts[places], self.starts[places + 1] - self.starts[places]
        rows = _ranges(begin, size)
        scores = np.zeros(len(self.ids), np.int64)
        np.add.at(scores, self.docs[rows], self.impacts[rows] * np.repeat(repeats, size))
        found = np.flatnonzero(scores >= max(floor, 1))
        if len(found) > top:
            order = np.lexsort((self.ids[found], self.named[found] == 0, -scores[found]))
            found = found[order[:top]]
        return scores[found], found


def _ranges(starts, sizes):
    """All numbers of the ranges from ``starts`` with ``sizes``."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) + np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)


def _portions(batches):
    """Blocks as dicts, in lists of about ``HELD_BYTES``, so that a task visits them by their bounds."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            more = sum(len(x) for x in row.values() if isinstance(x, bytes))
            if held and size + more > HELD_BYTES:
                yield held
                held, size = [], 0
            held.append(row)
            size += more
    if held:
        yield held


def _searched(sent, weights, floors, top: int, seeds: int):
    """(number, doc_id, score) of the best documents of each task. ``seeds``: blocks to visit per item and portion; 0 for all that reach the floor.
    ``sent``, ``weights``, ``floors``: broadcast arrays."""

    def rows(batches):
        items = Items(*sent.value)
        best = floors.value.copy()  # the top-th best score seen so far
        seen = [np.zeros(0, np.int64)] * len(items.numbers)
        for portion in _portions(batches):
            blocks = [_Block(row, items, weights.value) for row in portion]
            bounds = np.stack([block.bound for block in blocks])
            order = np.argsort(-bounds, axis=0, kind="stable")
            for item in range(len(items.numbers)):
                for block in order[: seeds or None, item].tolist():
                    if bounds[block, item] < max(best[item], 1):
                        break
                    scores, found = blocks[block].best(items, item, top, best[item])
                    if not len(found):
                        continue
                    seen[item] = np.sort(np.concatenate((seen[item], scores)))[-top:]
                    if len(seen[item]) == top:
                        best[item] = max(best[item], seen[item][0])
                    ids, named = blocks[block].ids[found], blocks[block].named[found]
                    columns = [pa.array(np.full(len(found), items.numbers[item])), pa.array(ids, mask=named == 0), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "score"])

    return rows


def _held_by(sent):
    """(place, docs): in how many documents of a task each of the items' terms occurs."""

    def rows(batches):
        terms = sent.value
        found = np.zeros(len(terms), np.int64)
        for batch in batches:
            for packed, groups, sizes in zip(*(batch.column(name).to_pylist() for name in ("terms", "groups", "group_sizes"))):
                known = np.frombuffer(packed, np.int64)
                at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                asked = np.flatnonzero(known[at] == terms)
                first = np.concatenate(([0], np.cumsum(np.frombuffer(groups, np.int32))))[:-1]
                found[asked] += np.add.reduceat(np.frombuffer(sizes, np.int32).astype(np.int64), first)[at[asked]]
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(found[places])], ["place", "docs"])

    return rows


def term_weights(frequencies, documents: int):
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * frequencies + 1))).astype(np.int64)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search(index: Index, items: Items, top: int) -> DataFrame:
    """(number, rank, doc_id, score) for the items of one broadcast."""
    spark = index.blocks.sparkSession
    context = spark.sparkContext
    kind = "number long, doc_id long, score long"
    narrow = index.blocks.select("terms", "groups", "group_sizes")
    counts = in_batches(narrow, _held_by(context.broadcast(items.terms)), "place long, docs long").groupBy("place").agg(F.sum("docs").alias("docs"))
    frequencies = np.zeros(len(items.terms), np.int64)
    for place, docs in counts.collect():  # a number per term of the items
        frequencies[place] = docs
    sent, weights = context.broadcast(items.plain()), context.broadcast(term_weights(frequencies, index.documents))
    floors = np.zeros(len(items.numbers), np.int64)
    seeded = in_batches(index.blocks, _searched(sent, weights, context.broadcast(floors), top, SEEDS), kind)
    at = {number: i for i, number in enumerate(items.numbers.tolist())}
    for number, score in _ranked(seeded, top).filter(F.col("rank") == top).select("number", "score").collect():  # one number per item
        floors[at[number]] = score
    return _ranked(in_batches(index.blocks, _searched(sent, weights, context.broadcast(floors), top, 0), kind), top)


def _packed_items(items: DataFrame) -> DataFrame:
    """(number, item_id, terms, tfs) of the distinct items that have a term."""
    asked = items.select(items["item_id"].alias("item_id"), items["text"].alias("text")).distinct()
    asked = asked.withColumn("number", F.xxhash64("item_id", "text"))

    def counted(batches):
        for batch in batches:
            rows = [counted_terms(text) for text in texts(batch)]
            packed = (pa.array([row[i].tobytes() for row in rows], pa.binary()) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([batch.column("number"), batch.column("item_id"), *packed], ["number", "item_id", "terms", "tfs"])

    kind = asked.schema["item_id"].dataType.simpleString()
    return materialise(in_batches(asked, counted, f"number long, item_id {kind}, terms binary, tfs binary").filter(F.length("terms") > 0), "items")


def search(index: Index, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) the ``top`` documents with the highest score above 0.

    Equal scores go by doc_id, documents without an id last; repeated documents are results of their own. An item that is there twice is one item, and
    items of one id with different texts are ranked apart. Items without terms, and null texts, find nothing. Items are sent in rounds of at
    most ``item_bytes`` of terms (or one item), each a search of its own.
    """
    packed = _packed_items(items)
    size = packed.agg(F.sum(F.length("terms") + F.length("tfs"))).first()[0]
    rounds = -(-size // item_bytes) if size else 0
    found = []
    for turn in range(rounds if index.documents else 0):
        rows = packed.filter(F.pmod("number", F.lit(rounds)) == turn).select("number", "terms", "tfs").collect()  # about ``item_bytes``
        if rows:
            found.append(_search(index, Items.of(sorted(map(tuple, rows))), top))
    if not found:
        return packed.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    named = reduce(DataFrame.unionByName, found).join(packed.select("number", "item_id"), "number")
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
