"""Periodic runs of words, found with suffix trees and Lyndon roots.

A run is a stretch with smallest period q that cannot be extended with this period. Every run holds a Lyndon root: a word of length q that is the
longest Lyndon word at its start for one of two orders of the alphabet, one the reverse of the other. The longest Lyndon word at i ends
before the next position whose suffix is smaller, so the suffix order of a text gives two candidates per position. A candidate of length q at i is
extended to the right by the longest common extension of i and i + q, and to the left by that of the reversed text.

Per document, Ukkonen's algorithm builds the suffix tree of the text and then that of its reversal, both over word numbers and a last symbol of
their own. An Euler tour of a tree notes, at each arrival at a node, the string depth of the node it came from; the longest common
extension of two suffixes is the smallest such depth between the arrivals at their leaves (the depth of their lowest common ancestor), which
block minima and a sparse table answer in constant time for all candidates of a document together.

The work of a document is linear but for sorting, and so is its memory, which bounds what one task holds: about 0.6 kB per word of the longest text. Short
documents of one batch are joined for the extension queries, so that numpy works on long arrays.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import in_batches, texts

LEAST_LENGTH = 6
LEAST_TIMES = 4
BLOCK = 16


def suffix_tree(symbols: list[int], size: int):
    """Ukkonen's suffix tree of ``symbols``, whose last one occurs nowhere else; all are below ``size``.

    Returns (edges, depth): ``edges`` maps node * size + first symbol to the child, and ``depth`` holds the string depths of the inner nodes. Node
    0 is the root; the leaf of suffix j is ~j.
    """
    edges: dict[int, int] = {}
    depth, at, link = [0], [0], [0]
    node = start = 0  # the suffix to be extended, and the deepest node on its path known so far
    for i, symbol in enumerate(symbols):
        pending = 0
        while start <= i:
            length = i - start
            below = depth[node]
            while below < length:
                key = node * size + symbols[start + below]
                child = edges[key]
                if child < 0:
                    break
                deeper = depth[child]
                if deeper > length:
                    break
                node, below = child, deeper
            if below == length:
                if pending:
                    link[pending] = node
                    pending = 0
                key = node * size + symbol
                if key in edges:
                    break
                edges[key] = ~start
            else:
                following = symbols[(~child if child < 0 else at[child]) + length]
                if following == symbol:
                    break
                new = len(depth)
                depth.append(length)
                at.append(start)
                link.append(0)
                edges[key] = new
                edges[new * size + following] = child
                edges[new * size + symbol] = ~start
                if pending:
                    link[pending] = new
                pending = new
            start += 1
            node = link[node]
    return edges, depth


def euler_tour(symbols: list[int], size: int):
    """(arrivals, came): per suffix the place of its leaf in the tour, and per place the string depth of the node the tour came from.

    Children are visited in the order of their symbols, so the leaves come in suffix order.
    """
    edges, depth = suffix_tree(symbols, size)
    keys = np.fromiter(edges.keys(), np.int64, len(edges))
    children = np.fromiter(edges.values(), np.int64, len(edges))
    del edges
    order = np.argsort(-keys)  # by parent and symbol, both descending: the stack below gives the smallest symbol first
    parents, children = keys[order] // size, children[order]
    inner = len(depth)
    counts = np.bincount(parents, minlength=inner)
    ends = len(children) - np.concatenate(([0], np.cumsum(counts)[:-1]))
    begins = (ends - counts).tolist()
    ends = ends.tolist()
    below = children.tolist()
    tour, stack = [], [0]
    pop, push, arrive = stack.pop, stack.extend, tour.append
    while stack:
        node = pop()
        arrive(node)
        if node >= 0:
            push(below[begins[node] : ends[node]])
    tour = np.array(tour, np.int64)
    leaves = np.flatnonzero(tour < 0)
    arrivals = np.empty(len(leaves), np.int64)
    arrivals[~tour[leaves]] = leaves
    # Nodes are numbered from -len(leaves) to inner - 1; shifted, so that they index an array of their parents' depths.
    came = np.zeros(len(leaves) + inner, np.int32)
    came[children + len(leaves)] = np.array(depth, np.int32)[parents]
    return arrivals, came[tour + len(leaves)]


class RangeMinimum:
    """Minimum of ``values`` between two places, in constant time: block minima in a sparse table, prefix and suffix minima within blocks."""

    def __init__(self, values):
        blocks = -(-len(values) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(values)] = values
        self.values = padded
        grid = padded.reshape(blocks, BLOCK)
        self.upto = np.minimum.accumulate(grid, axis=1).ravel()
        self.onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [grid.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def between(self, low, high):
        """Minimum of values[low : high + 1] for arrays of places, low <= high."""
        first, last = low // BLOCK, high // BLOCK
        found = np.minimum(self.onward[low], self.upto[high])
        inner = last - first - 1
        level = np.frexp(np.maximum(inner, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[inner > 0]):
            rows = np.flatnonzero((inner > 0) & (level == k))
            table = self.levels[k]
            middle = np.minimum(table[first[rows] + 1], table[last[rows] - (1 << int(k))])
            found[rows] = np.minimum(found[rows], middle)
        rows = np.flatnonzero(inner < 0)  # both in one block
        if len(rows):
            reach = low[rows][:, None] + np.arange(BLOCK)
            inside = np.where(reach <= high[rows][:, None], self.values[np.minimum(reach, len(self.values) - 1)], np.iinfo(np.int32).max)
            found[rows] = inside.min(axis=1)
        return found


def _extensions(arrivals, minimum: RangeMinimum, i, j):
    one, other = arrivals[i], arrivals[j]
    return minimum.between(np.minimum(one, other) + 1, np.maximum(one, other)).astype(np.int64)


def lyndon_ends(order: list[int]):
    """For each position of a suffix order the next position with a smaller and with a larger suffix (its length if there is none)."""
    n = len(order)
    smaller, larger = [n] * n, [n] * n
    for i in range(n - 1, -1, -1):
        rank, j = order[i], i + 1
        while j < n and order[j] > rank:
            j = smaller[j]
        smaller[i] = j
        j = i + 1
        while j < n and order[j] < rank:
            j = larger[j]
        larger[i] = j
    return smaller, larger


def _one_side(documents: list[list[int]]):
    """Tours of several documents as one: (arrivals by word of all documents and one closing symbol each, minimum over the joint tour)."""
    arrivals, came, shift = [], [], 0
    for symbols in documents:
        places, depths = euler_tour([*symbols, len(symbols)], len(symbols) + 1)
        arrivals.append(places + shift)
        came.append(depths)
        shift += len(depths)
    return np.concatenate(arrivals), RangeMinimum(np.concatenate(came))


def find_runs(documents: list[list[int]], least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES):
    """Runs of several documents, each a list of symbols below its length: arrays (document, start, length, period), ordered by document,
    start and period. ``least_times`` of at least 2."""
    lengths = np.array([len(x) for x in documents], np.int64)
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not len(documents) or not lengths.sum():
        return none
    bases = np.concatenate(([0], np.cumsum(lengths + 1)))  # each document is followed by its closing symbol
    arrivals, minimum = _one_side(documents)
    starts, roots, owners = [], [], []
    for d, (base, n) in enumerate(zip(bases[:-1].tolist(), lengths.tolist())):
        here = np.arange(n)
        for ends in lyndon_ends(arrivals[base : base + n].tolist()):
            starts.append(here)
            roots.append(np.array(ends, np.int64) - here)
            owners.append(np.full(n, d))
    start, period, owner = np.concatenate(starts), np.concatenate(roots), np.concatenate(owners)
    # A candidate at the end of its text is the last of its run, and an earlier one finds the same run.
    open_ = np.flatnonzero(start + period < lengths[owner])
    start, period, owner = start[open_], period[open_], owner[open_]
    ahead = _extensions(arrivals, minimum, bases[owner] + start, bases[owner] + start + period)
    del arrivals, minimum
    # The first root of a run begins within its first period, so all of the run but two periods lies ahead of it. Only texts
    # with such a root have a run, and are read backwards.
    far = np.flatnonzero(ahead > (least_times - 2) * period)
    if not len(far):
        return none
    start, period, owner, ahead = start[far], period[far], owner[far], ahead[far]
    chosen, back = np.unique(owner, return_inverse=True)
    arrivals, minimum = _one_side([documents[d][::-1] for d in chosen])
    ends = np.cumsum(lengths[chosen] + 1)[back] - 2  # the reversed place of a text's first word
    behind = np.zeros(len(start), np.int64)
    inner = np.flatnonzero(start > 0)
    behind[inner] = _extensions(arrivals, minimum, (ends - start + 1)[inner], (ends - start - period + 1)[inner])
    begin, length = start - behind, behind + period + ahead
    long_ = np.flatnonzero((length >= least_length) & (length >= least_times * period))
    found = np.unique(np.stack((owner[long_], begin[long_], length[long_], period[long_])), axis=1)
    # A stretch found with several periods has the smallest.
    first = np.ones(found.shape[1], bool)
    first[1:] = (np.diff(found[:3], axis=1) != 0).any(axis=0)
    owner, begin, length, period = found[:, first]
    order = np.lexsort((period, begin, owner))
    return owner[order], begin[order], length[order], period[order]


def collapsed(words: list, starts, lengths, periods) -> list:
    """``words`` without those that a run holds after its first period."""
    if not len(starts):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    kept = np.cumsum(change[:-1]) == 0
    return [word for word, keep in zip(words, kept.tolist()) if keep]


def repeated_tail(words: list, doc_id: int | None) -> list:
    """The words that a document is judged by: of every tenth id (by crc32), the words from a place on are repeats of the first few there."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def numbered(words: list) -> list[int]:
    """Words as numbers by first occurrence."""
    numbers: dict = {}
    return [numbers.setdefault(word, len(numbers)) for word in words]


JOINED_WORDS = 1 << 16  # words of documents that are joined for the extension queries, or one document
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _described(ids, bodies, least_length, least_times):
    """One record batch for some documents."""
    words = [body.split() if body else [] for body in bodies]  # bytes: white space is \x20 \x09-\x0D
    if ids is not None:
        words = [repeated_tail(found, doc_id) for found, doc_id in zip(words, ids)]
    owner, start, length, period = find_runs([numbered(found) for found in words], least_length, least_times)
    cuts = np.searchsorted(owner, np.arange(len(words) + 1))
    left = [b" ".join(collapsed(found, *(x[a:b] for x in (start, length, period)))) for found, a, b in zip(words, cuts, cuts[1:])]
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
    return [
        pa.array([len(found) for found in words], pa.int64()),
        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs).cast(_RUNS),
        pa.array(left, pa.binary()).cast(pa.string()),
    ]


def _portions(bodies):
    """(from, to) of stretches of documents with about ``JOINED_WORDS`` words."""
    begin = held = 0
    for i, body in enumerate(bodies):
        more = len(body or b"") // 5
        if held and held + more > JOINED_WORDS:
            yield begin, i
            begin, held = i, 0
        held += more
    if begin < len(bodies):
        yield begin, len(bodies)


def _run_rows(least_length: int, least_times: int, tails: bool):
    def rows(batches):
        for batch in batches:
            bodies = texts(batch)
            ids = batch.column("doc_id").to_pylist()
            for low, high in _portions(bodies):
                columns = _described(ids[low:high] if tails else None, bodies[low:high], least_length, least_times)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), *columns], ["doc_id", "n_words", "runs", "collapsed"])

    return rows


def word_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, repeat_tails: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period; by start, then period), collapsed (the text without repeats).

    A run has at least ``least_length`` words and ``least_times`` (2 or more) times its period. ``repeat_tails`` first repeats the tail of every tenth
    document, as the query's contract asks. Null and empty texts, and texts without words, have no runs and collapse to an empty string. A null
    doc_id stays null, and its tail is not repeated; repeated rows stay. Only doc_id and text are read. An empty table gives no rows.
    """
    if least_times < 2:
        raise ValueError("a run has its period twice at least")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return in_batches(rows, _run_rows(least_length, least_times, repeat_tails), f"doc_id long, {_SCHEMA}")
