"""Exact top-k inner-product search with multi-resolution segment statistics.

Vectors are cut into segments. With the mean m and the deviation s (length of the residual) of each segment of w components, an inner
product is at most the sum of w m m' + s s' over the segments, which bounds the distance (minus the product) from below. Bounds are
computed for one segment, then 4, then 16; pairs whose bound falls below the k-th best score of their query so far are dropped,
and the others are computed exactly. A bound of a block of queries and a block of candidates is one matrix product.

Candidates are packed into blocks where they lie and are never shuffled. Queries are packed into blocks too, and are sent to the candidates in
rounds of at most ``ROUND_BYTES`` of vectors, each of which reads the candidates once. Only the k best of a block pair go on.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_batches
from tidemark.session import materialise

SCALE = 1024
TOP = 10
LEVELS = (1, 4, 16)
BLOCK_BYTES = 2 << 20
QUERY_ROWS = 512
ROUND_BYTES = 4 << 20
EXACT = 2.0**53


def _valid(batch):
    """(ids, dimension, rows) of the vectors that take part, scaled and rounded down, by dimension."""
    ids, vectors = batch.column("vec_id"), batch.column("embedding")
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = vectors.offsets.to_numpy()
    known = ~(ids.is_null().to_numpy(zero_copy_only=False) | vectors.is_null().to_numpy(zero_copy_only=False))
    lengths = np.diff(offsets)
    for dim in np.unique(lengths[known & (lengths > 0)]):
        chosen = np.flatnonzero(known & (lengths == dim))
        rows = flat[offsets[chosen][:, None] + np.arange(dim)]  # null components arrive as NaN
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.floor(SCALE * rows)
        good = np.isfinite(scaled).all(axis=1)
        if good.any():
            yield ids.take(pa.array(chosen[good])).to_numpy(zero_copy_only=False).astype(np.int64), int(dim), scaled[good]


def _packed(rows_of):
    """Blocks of at most ``rows_of(dimension)`` vectors from the rows of a partition."""

    def pack(batches):
        held = {}

        def out(dim, ids, rows):
            packed = [pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in (ids, rows)]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *packed], ["dim", "ids", "vectors"])

        for batch in batches:
            for ids, dim, rows in _valid(batch):
                size = rows_of(dim)
                for low in range(0, len(ids), size):
                    kept = held.setdefault(dim, ([], []))
                    kept[0].append(ids[low : low + size])
                    kept[1].append(rows[low : low + size])
                    if sum(map(len, kept[0])) >= size:
                        yield out(dim, *held.pop(dim))
        for dim, (ids, rows) in held.items():
            yield out(dim, ids, rows)

    return pack


def _block_rows(dim: int) -> int:
    return max(16, BLOCK_BYTES // (8 * dim) // 2)


def _query_rows(dim: int) -> int:
    return max(1, min(QUERY_ROWS, BLOCK_BYTES // (8 * dim)))


def statistics(rows, parts: int):
    """Per vector sqrt(w) x mean and deviation of each segment, so that products of two such rows are upper bounds."""
    edges = np.unique(np.linspace(0, rows.shape[1], min(parts, rows.shape[1]) + 1).astype(int))
    widths = np.diff(edges)
    sums = np.add.reduceat(rows, edges[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, edges[:-1], axis=1)
    return np.hstack((sums / np.sqrt(widths), np.sqrt(np.maximum(0, squares - sums * sums / widths))))


def _scores(queries, candidates, at, to):
    """Exact inner products of pairs; Python integers where doubles would round, held to 64 bits."""
    limit = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * queries.shape[1]
    if limit < EXACT:
        return np.einsum("ij,ij->i", queries[at], candidates[to])
    whole = [sum(int(a) * int(b) for a, b in zip(queries[i], candidates[j])) for i, j in zip(at, to)]
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in whole], object)


def best_pairs(query_ids, queries, ids, candidates, top: int, floor):
    """(query row, candidate row, score) of all pairs that may be among the ``top`` of their query. ``floor``: a score per query
    that its results must reach."""
    slack = 1 + 1e-9 * np.abs(queries).max(initial=1) * np.abs(candidates).max(initial=1) * queries.shape[1]
    own = query_ids[:, None] == ids[None, :]
    bound = statistics(queries, LEVELS[0]) @ statistics(candidates, LEVELS[0]).T
    bound[own] = -np.inf
    # The most promising candidates by the coarsest bound raise the floor.
    size = min(top, len(ids))
    first = np.argpartition(-bound, size - 1, axis=1)[:, :size]
    at = np.repeat(np.arange(len(queries)), size)
    seen = _scores(queries, candidates, at, first.ravel()).astype(np.float64).reshape(len(queries), size)
    seen[np.take_along_axis(own, first, axis=1)] = -np.inf
    if size == top:
        floor = np.maximum(floor, seen.min(axis=1))
    alive = ~own & (bound + slack >= floor[:, None])
    for parts in LEVELS[1:]:
        columns, rows = np.flatnonzero(alive.any(axis=0)), np.flatnonzero(alive.any(axis=1))
        if not len(columns):
            break
        finer = statistics(queries[rows], parts) @ statistics(candidates[columns], parts).T
        alive[np.ix_(rows, columns)] &= finer + slack >= floor[rows, None]
    at, to = np.nonzero(alive)
    return at, to, _scores(queries, candidates, at, to)


def _searched(top: int):
    def rows(batches):
        floors = {}  # k-th best score of each query of a block, over the candidate blocks this task has seen
        for batch in batches:
            for dim, query_ids, queries, ids, candidates in zip(*(batch.column(i).to_pylist() for i in range(5))):
                query_ids, ids = np.frombuffer(query_ids, np.int64), np.frombuffer(ids, np.int64)
                queries, candidates = (np.frombuffer(x, np.float64).reshape(-1, dim) for x in (queries, candidates))
                best = floors.setdefault((dim, query_ids.tobytes()), np.full((len(query_ids), top), -np.inf))
                at, to, scores = best_pairs(query_ids, queries, ids, candidates, top, best.min(axis=1))
                if not len(at):
                    continue
                order = np.lexsort((ids[to], -scores.astype(np.float64) if scores.dtype != object else [-x for x in scores], at))
                at, to, scores = at[order], to[order], scores[order]
                rank = np.arange(len(at)) - np.searchsorted(at, at)
                kept = rank < top
                at, to, scores, rank = at[kept], to[kept], scores[kept], rank[kept]
                found = np.full(best.shape, -np.inf)
                found[at, rank] = scores.astype(np.float64)
                best[:] = -np.sort(-np.hstack((best, found)), axis=1)[:, :top]
                numbers = pa.array([int(x) for x in scores] if scores.dtype == object else scores.astype(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[at]), pa.array(ids[to]), numbers], ["query_id", "vec_id", "score"])

    return rows


def top_pairs(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query vector the ``top`` rows of ``vectors`` with the largest inner product.

    Both tables have vec_id and embedding. Components are scaled by 1024 and rounded down; ties go to the smaller vec_id. A vector that is null,
    empty or has a null or non-finite component, or no vec_id, takes no part. Rows with the query's own vec_id are not its results.
    Vectors of another length have no product with the query. A repeated query row is one query; repeated candidates
    are results of their own. Scores beyond 64 bits are held at the ends of the range. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    asked = queries.select("vec_id", "embedding").distinct()
    total, dim = asked.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not total or not dim or dim < 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    kinds = "dim int, ids binary, vectors binary"
    parts = -(-total // QUERY_ROWS)
    rounds = max(1, -(-total * dim * 8 // ROUND_BYTES))
    packed = in_batches(asked.repartition(parts), _packed(_query_rows), kinds)
    packed = materialise(packed.withColumn("round", F.pmod(F.xxhash64("ids"), F.lit(rounds)).cast("int")), "queries")
    blocks = in_batches(vectors.select("vec_id", "embedding"), _packed(_block_rows), kinds)
    blocks = blocks.withColumnsRenamed({"ids": "other_ids", "vectors": "others"})
    found = []
    for turn in range(rounds):
        sent = F.broadcast(packed.filter(F.col("round") == turn).drop("round"))  # about ROUND_BYTES
        pairs = blocks.join(sent, "dim").select("dim", "ids", "vectors", "other_ids", "others")
        found.append(pairs.mapInArrow(_searched(top), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
