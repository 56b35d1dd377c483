"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

Every word (of whole texts, case kept; runs of punctuation are words too) hashes to one of ``BUCKETS`` rows. A row has a fixed
sparse random index vector, and its context vector is the sum of the index vectors of the words up to ``REACH`` places away, over
all documents. Tasks add up their own documents and pass on one table of fixed size each; these are summed and scaled to unit
length. A document is the mean and the deviation of its words' vectors, the mean product of neighbouring ones, and its length. A
network of one hidden layer, written in numpy, is fitted on a bounded sample of labelled documents (at most ``PER_CLASS`` rows
per label), and its temperature on a part of the sample that the network has not seen.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_of, in_batches, texts
from tidemark.llm.samples import labelled_sample, one_per_id, sampled_rows

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
PER_CLASS = 3000
BUCKETS = 1 << 14
WIDTH = 32
NONZERO = 4
REACH = 2
CHUNKS = 128  # parts in which a table of context vectors is passed on
HIDDEN = 32
EPOCHS, RATE, DECAY = 400, 0.01, 1e-4
CACHED_WORDS = 100_000
TOKENS = 1 << 16  # read at a time
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")


class _Buckets(dict):
    """Row of a word, hashed once per word."""

    def __missing__(self, word):
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh32_intdigest(word) % BUCKETS
        return found


def word_rows(text: bytes | None, buckets) -> np.ndarray:
    found = _WORD.findall(text or b"")
    return np.fromiter(map(buckets.__getitem__, found), np.int64, len(found))


def index_vectors() -> np.ndarray:
    """BUCKETS sparse vectors with as many +1 as -1, and one zero row for 'no word'."""
    chance = np.random.default_rng(7)
    places = np.argsort(chance.random((BUCKETS, WIDTH)), axis=1)[:, :NONZERO]
    table = np.zeros((BUCKETS + 1, WIDTH), np.int16)
    np.put_along_axis(table[:BUCKETS], places, np.tile(np.array([1, -1], np.int16), NONZERO // 2)[None, :].repeat(BUCKETS, 0), axis=1)
    return table


def add_contexts(table: np.ndarray, rows: np.ndarray, index: np.ndarray) -> None:
    """Add the neighbours' index vectors of one text to ``table``, a part of the text at a time."""
    padded = np.concatenate((np.full(REACH, BUCKETS), rows, np.full(REACH, BUCKETS)))
    for low in range(0, len(rows), TOKENS):
        part = rows[low : low + TOKENS]
        near = sum(index[padded[low + k : low + k + len(part)]] for k in range(2 * REACH + 1) if k != REACH)
        order = np.argsort(part, kind="stable")
        words, first = np.unique(part[order], return_index=True)
        table[words] += np.add.reduceat(near[order], first, axis=0, dtype=np.int64)


def _contexts(batches):
    index, buckets = index_vectors(), _Buckets()
    table = np.zeros((BUCKETS, WIDTH), np.int64)
    none, held, size = np.full(REACH, BUCKETS), [], 0
    for batch in batches:
        for text in texts(batch):  # short texts are added together, with gaps between them
            rows = word_rows(text, buckets)
            held += [rows, none]
            size += len(rows)
            if size >= TOKENS:
                _add_all(table, held, index)
                held, size = [], 0
    if held:
        _add_all(table, held, index)
    parts = table.astype(np.float64).reshape(CHUNKS, -1)
    used = np.flatnonzero(parts.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())], ["chunk", "sums"])


def _add_all(table, held, index):
    rows = np.concatenate(held)
    wide = np.zeros((BUCKETS + 1, WIDTH), np.int64)
    add_contexts(wide, rows, index)
    table += wide[:BUCKETS]


def _summed(batches):
    sums = {}
    for batch in batches:
        for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist()):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(part, np.float64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([part.tobytes() for part in sums.values()], pa.binary())], ["chunk", "sums"]
        )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x WIDTH context vectors of unit length, from all of ``docs``; a fixed size, whatever the input."""
    parts = in_batches(docs.select(docs["text"].alias("text")), _contexts, "chunk int, sums binary")
    summed = parts.repartition("chunk").mapInArrow(_summed, "chunk int, sums binary").collect()  # CHUNKS rows
    table = np.zeros((CHUNKS, BUCKETS * WIDTH // CHUNKS))
    for row in summed:
        table[row.chunk] = np.frombuffer(bytes(row.sums), np.float64)
    table = table.reshape(BUCKETS, WIDTH)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: bytes | None, vectors: np.ndarray, buckets) -> np.ndarray:
    """Mean and deviation of the word vectors, how alike neighbouring words are, and the logarithm of the number of words."""
    rows = word_rows(text, buckets)
    total, squares, alike = np.zeros(WIDTH), np.zeros(WIDTH), 0.0
    for low in range(0, len(rows), TOKENS):
        part = vectors[rows[low : low + TOKENS + 1]]
        alike += float(np.einsum("ij,ij->", part[:-1], part[1:], dtype=np.float64))
        part = part[:TOKENS]
        total += part.sum(axis=0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", part, part, dtype=np.float64)
    n = max(1, len(rows))
    mean = total / n
    return np.concatenate((mean, np.sqrt(np.maximum(0, squares / n - mean * mean)), [alike / max(1, len(rows) - 1), np.log1p(len(rows)) / 10]))


def _pooled(vectors):
    def rows(batches):
        buckets = _Buckets()
        for batch in batches:
            found = [pooled(text, vectors.value, buckets).tolist() for text in texts(batch)]
            kept = ("doc_id", "text_key", "label")
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(found, pa.list_(pa.float64()))], [*kept, "pooled"])

    return rows


@dataclass(frozen=True)
class QualityModel:
    center: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float

    def plain(self) -> tuple:
        """The fields, for a broadcast: executors need not know the class."""
        return self.center, self.scale, self.inner, self.inner_bias, self.outer, self.outer_bias, self.temperature

    def probability(self, pooled_rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(pooled_rows) / self.temperature, -60, 60)))

    def logit(self, pooled_rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh((pooled_rows - self.center) / self.scale @ self.inner + self.inner_bias)
        return hidden @ self.outer + self.outer_bias


def fit(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> QualityModel | None:
    """Adam on the weighted log loss of four rows in five; the fifth sets the temperature. None unless both labels occur."""
    if len(set(y.tolist())) < 2:
        return None
    chance = np.random.default_rng(11)
    kept_out = np.arange(len(y)) % 5 == 4
    if len(set(y[~kept_out].tolist())) < 2 or not kept_out.any():
        kept_out[:] = False
    train = ~kept_out
    center, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    z, target, w = (x[train] - center) / scale, y[train], weights[train] / weights[train].sum()
    state = [chance.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), chance.normal(0, 0.1, HIDDEN), np.zeros(1)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in state]
    for turn in range(1, EPOCHS + 1):
        hidden = np.tanh(z @ state[0] + state[1])
        error = w * (1 / (1 + np.exp(-np.clip(hidden @ state[2] + state[3], -60, 60))) - target)
        back = np.outer(error, state[2]) * (1 - hidden * hidden)
        slopes = [z.T @ back + DECAY * state[0], back.sum(axis=0), hidden.T @ error + DECAY * state[2], np.array([error.sum()])]
        for p, g, m in zip(state, slopes, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            p -= RATE * (m[0] / (1 - 0.9**turn)) / (np.sqrt(m[1] / (1 - 0.999**turn)) + 1e-8)
    model = QualityModel(center, scale, state[0], state[1], state[2], float(state[3][0]), 1.0)
    if not kept_out.any():
        return model
    logits, seen, w = model.logit(x[kept_out]), y[kept_out], weights[kept_out]
    choices = np.geomspace(0.25, 8, 60)
    losses = [np.sum(w * (np.logaddexp(0, logits / t) - seen * logits / t)) for t in choices]
    return QualityModel(center, scale, state[0], state[1], state[2], float(state[3][0]), float(choices[int(np.argmin(losses))]))


def _scored(model, vectors):
    def rows(batches):
        buckets = _Buckets()
        network = QualityModel(*model.value) if model.value else None
        for batch in batches:
            found = np.array([pooled(text, vectors.value, buckets) for text in texts(batch)]).reshape(batch.num_rows, -1)
            scores = network.probability(found) if network else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return rows


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have no words: they are scored by the network from zero vectors. Without labelled rows of both kinds every score is 0.5. A
    row without doc_id is not held out and not learned from. Word vectors are taken from all documents, without their labels.
    Only doc_id and text of ``docs`` and doc_id and quality of ``labels`` are read; repeated rows are scored each on its own.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    vectors = context.broadcast(word_vectors(docs))  # BUCKETS x WIDTH numbers
    known = labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].alias("label"))
    sample, counts = labelled_sample(known.filter((fold_of("doc_id", FOLDS) != HELD_OUT) & F.col("label").isin(0, 1)), per_class)
    # Pooled where the texts lie; one row per sampled id comes to the driver.
    chosen = in_batches(sampled_rows(docs, sample), _pooled(vectors), f"doc_id {kind}, text_key bigint, label string, pooled array<double>")
    found = sorted(one_per_id(chosen).collect())
    counts = {row.label: row.n for row in counts.collect()}  # two labels
    y = np.array([int(row.label) for row in found])
    model = None
    if found:
        weights = np.array([counts[row.label] for row in found]) / np.bincount(y, minlength=2)[y]  # back to the shares of all labels
        # Rows in an order of their own, so that every fifth is a fair part of both labels.
        order = np.argsort([xxhash.xxh64_intdigest(str(row.doc_id)) for row in found])
        model = fit(np.array([row.pooled for row in found])[order], y[order], weights[order])
    scored = in_batches(rows, _scored(context.broadcast(model and model.plain()), vectors), f"doc_id {kind}, score double")
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
