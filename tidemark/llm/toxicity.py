"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, are trained from labels of whole documents.

A sentence scores sigmoid(bias + the weights of its distinct words and of their prefixes), and a document is toxic unless none of its
sentences is: 1 - product(1 - sentence score) / product(1 - score of a sentence without evidence). So a sentence counts by what it has above
the bias, and length alone adds nothing. Weights are not negative, and only features have one that toxic documents hold more often than chance
explains, given how many features are tried, and clean ones hardly ever: words that few documents hold would otherwise add up in a long text. Offending sentences are
those whose own score passes a half.

The model is fitted on a bounded sample (at most ``PER_CLASS`` rows per label) of whole texts, however long. Tasks count the holders of each
feature, and then reduce each text to its distinct sets of telling features (the ``BAGS`` strongest, with how often each comes); only those
reach the driver, where numpy finds the weights. Every whole text is scored in Spark tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.llm.common import fold_of, free_name, in_batches, quoted, texts
from tidemark.llm.samples import labelled_sample, one_per_id, sampled_rows
from tidemark.session import materialise

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
PER_CLASS = 2000
BAGS = 256  # distinct sets of telling features that a text is fitted by
COUNTED = 200_000  # features that a task counts before it passes them on
MIN_DOCS = 4
PREFIXES = (5, 6, 7, 8)
SPAN = 64  # words of a sentence that are judged together
CHANCE = 0.05  # share of the features that may pass the test below by chance
ODDS = 20  # a toxic document is at least so many times as likely to hold a feature as a clean one
BIAS = -9.0
ROUNDS, RATE, SHRINK = 250, 0.2, 5e-5
CACHED_WORDS = 100_000
_ENDS = b".!?\n\r"
# Sentence ends become newlines and other bytes outside words blanks; lengths, and so positions, stay.
_CUT = bytes(
    0x0A if b in _ENDS else b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def features(word: bytes) -> list[bytes]:
    return [word, *(b"^" + word[:n] for n in PREFIXES if len(word) > n)]


def _spans(sentence: bytes) -> list[set[bytes]]:
    """Distinct words of each SPAN words, so that a long line is not judged as one sentence."""
    words = sentence.split()
    return [set(words[low : low + SPAN]) for low in range(0, len(words), SPAN)]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[bytes, float]
    bias: float = BIAS


def _spans_of(text: bytes):
    for sentence in text.translate(_CUT).split(b"\n"):
        yield from _spans(sentence)


def _features_of(text: bytes) -> set[bytes]:
    return {feature for word in set(text.translate(_CUT).split()) for feature in features(word)}


def _bags(text: bytes, index: dict[bytes, tuple[int, float]]) -> list[tuple[tuple[int, ...], int]]:
    """The sets of telling features (``index``: number and strength) that spans of the text hold, and how many spans hold each."""
    found, seen = Counter(), {}
    for span in _spans_of(text):
        held = set()
        for word in span:
            if word not in seen:
                if len(seen) >= CACHED_WORDS:
                    seen.clear()
                seen[word] = [index[f] for f in features(word) if f in index]
            held.update(seen[word])
        if held:
            found[tuple(sorted(held))] += 1
    strongest = sorted(found.items(), key=lambda bag: (-sum(x for _, x in bag[0]), bag[0]))[:BAGS]
    return [(tuple(i for i, _ in bag), times) for bag, times in strongest]


def _divergence(held, expected) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(held > 0, held * np.log(held / held.sum(axis=1)[:, None] / expected), 0).sum(axis=1)


def telling(held, tried: int, expected) -> np.ndarray:
    """Which rows (clean, toxic documents that hold a feature) are too toxic for chance.

    By chance a holder is toxic with the share that toxic documents have in all holders of all features (``expected``: clean, toxic). The
    Chernoff bound of the binomial tail, exp(-holders x divergence), is tested with a false discovery rate of CHANCE among ``tried``
    features; rows whose bound is above CHANCE may be missing. A feature that clean documents contradict (less than ODDS) does not tell
    either: it would come up again and again in a long clean text.
    """
    if not len(held) or not expected.all():
        return np.zeros(len(held), bool)
    divergence = _divergence(held, expected)
    # Benjamini-Hochberg: the weakest of n features that pass is below CHANCE x n / features.
    ranked = np.sort(np.where(held[:, 1] > held.sum(axis=1) * expected[1], divergence, 0))[::-1]
    passed = np.flatnonzero(ranked > np.log(tried / CHANCE / np.arange(1, len(held) + 1)))
    least = ranked[passed[-1]] if len(passed) else math.inf
    return (held[:, 1] * expected[0] > ODDS * held[:, 0] * expected[1]) & (divergence >= least)


def _index(names: list[bytes], held, tried: int, expected) -> dict[bytes, tuple[int, float]]:
    """Number and strength of each telling feature."""
    chosen, strength = np.flatnonzero(telling(held, tried, expected)).tolist(), _divergence(held, expected)
    return {names[i]: (at, float(strength[i])) for at, i in enumerate(chosen)}


def fit(documents: list[bytes], labels: list[int]) -> ToxicityModel:
    """The steps of ``fit_on`` on texts at hand."""
    counts = Counter(), Counter()
    for text, label in zip(documents, labels):
        counts[label].update(_features_of(text))
    names = sorted(f for f in counts[0].keys() | counts[1].keys() if counts[0][f] + counts[1][f] >= MIN_DOCS)
    held = np.array([(counts[0][f], counts[1][f]) for f in names], float).reshape(-1, 2)
    index = _index(names, held, len(held), held.sum(axis=0) / max(1, held.sum()))
    return solve(list(index), [_bags(text, index) for text in documents], labels)


def solve(names: list[bytes], documents: list, labels: list[int]) -> ToxicityModel:
    """Adam on the noisy-or likelihood of documents given by ``_bags``, with weights kept at or above zero; both labels weigh the same."""
    bags = [(doc, bag, times) for doc, found in enumerate(documents) for bag, times in found]
    if len(set(labels)) < 2 or not bags:
        return ToxicityModel({})
    owner = np.array([doc for doc, _, _ in bags], np.int32)
    times = np.array([n for _, _, n in bags], float)
    flat = np.array([f for _, bag, _ in bags for f in bag], np.int32)
    sentence = np.repeat(np.arange(len(bags), dtype=np.int32), [len(bag) for _, bag, _ in bags])
    y = np.array(labels)
    importance = np.where(y == 1, 1 / (2 * y.sum()), 1 / (2 * (1 - y).sum()))
    w, quiet = np.zeros(len(names)), math.log1p(math.exp(BIAS))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for turn in range(1, ROUNDS + 1):
        z = BIAS + np.bincount(sentence, w[flat], len(bags))
        # One background for a whole document, so that there is a slope to start from.
        total = quiet + np.bincount(owner, times * (np.logaddexp(0, z) - quiet), len(documents))
        # Per unit of soft: +1 for clean documents, -exp(-T) / (1 - exp(-T)) for toxic ones.
        pull = np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-12, 700)), 1.0) * importance
        slope = times * (pull[owner] / (1 + np.exp(-z))).clip(-1, 1)
        g = np.bincount(flat, slope[sentence], len(names)) + SHRINK
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        fix = math.sqrt(1 - 0.99**turn) / (1 - 0.9**turn)
        w = np.maximum(0, w - RATE * fix * m / (np.sqrt(v) + 1e-6))
    return ToxicityModel({names[i]: float(w[i]) for i in np.flatnonzero(w > 0.05)})


class _Evidence(dict):
    """Weight of a word with its prefixes, looked up once per word."""

    def __init__(self, weights):
        super().__init__()
        self.weights = weights

    def __missing__(self, word):
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = sum(self.weights.get(f, 0.0) for f in features(word))
        return found


def score_text(text: bytes | None, evidence, bias: float) -> tuple[float, list[tuple[int, int, float]]]:
    """(document score, [(first byte, length, score) of each offending sentence])"""
    total, at, offending = 0.0, 0, []
    quiet = math.log1p(math.exp(bias))
    for sentence in (text or b"").translate(_CUT).split(b"\n"):
        most = 0.0
        for span in _spans(sentence):
            seen = sum(map(evidence.__getitem__, span))
            if seen:
                z = bias + seen
                total += (z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))) - quiet
                most = max(most, z)
        if most > 0:
            offending.append((at, len(sentence), 1 / (1 + math.exp(-most))))
        at += len(sentence) + 1
    return -math.expm1(-total), offending


_SENTENCES = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())]))
OFFENDING = ArrayType(StructType().add("start", "long").add("length", "long").add("score", "double"))


def _scored(model, column: str):
    """``model``: broadcast weights and bias. Appends the score and the offending sentences of the texts in a column."""

    def rows(batches):
        weights, bias = model.value
        evidence = _Evidence(weights)
        for batch in batches:
            found = [score_text(text, evidence, bias) for text in texts(batch, column)]
            sentences = [[{"start": a, "length": n, "score": p} for a, n, p in s] for _, s in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p for p, _ in found], pa.float64()), pa.array(sentences, _SENTENCES)],
                [*batch.schema.names, "score", "offending"],
            )

    return rows


def _holders(batches):
    """How many clean and toxic texts hold each feature; a feature comes in several rows."""
    counts = Counter(), Counter()

    def counted():
        names = sorted(counts[0].keys() | counts[1].keys())
        columns = [pa.array(names, pa.binary()), *(pa.array([c[f] for f in names], pa.int64()) for c in counts)]
        return pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

    for batch in batches:
        for text, label in zip(texts(batch), batch.column("label").to_pylist()):
            counts[int(label)].update(_features_of(text or b""))
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield counted()
                counts[0].clear()
                counts[1].clear()
    yield counted()


def _reduced(index):
    """``index``: a broadcast one. Each text as its bags."""

    def rows(batches):
        for batch in batches:
            found = [_bags(text or b"", index.value) for text in texts(batch)]
            bags = pa.array([[bag for bag, _ in x] for x in found], pa.list_(pa.list_(pa.int32())))
            times = pa.array([[n for _, n in x] for x in found], pa.list_(pa.int64()))
            kept = ("doc_id", "text_key", "label")
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), bags, times], [*kept, "bags", "times"])

    return rows


def fit_on(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on labelled rows outside the held-out fold. Without labels of both kinds every text scores about 0."""
    known = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].alias("label"))
    sample, _ = labelled_sample(known.filter((fold_of("doc_id", FOLDS) != HELD_OUT) & F.col("label").isin(0, 1)), per_class)
    # The sampled texts are read twice below; written aside, only the first time from all documents.
    rows = materialise(sampled_rows(docs, sample).drop("rank"), "toxicity_sample")
    held = in_batches(rows, _holders, "feature binary, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    held = materialise(held.filter(F.col("clean") + F.col("toxic") >= MIN_DOCS), "toxicity_features")
    tried, clean, toxic = held.agg(F.count("*"), F.sum("clean"), F.sum("toxic")).first()
    if not clean or not toxic:
        return ToxicityModel({})
    expected = np.array([clean, toxic]) / (clean + toxic)
    # Only features that can pass the test come to the driver.
    share = [F.col(c) / (F.col("clean") + F.col("toxic")) / float(e) for c, e in zip(("clean", "toxic"), expected)]
    clean_part = F.when(F.col("clean") > 0, F.col("clean") * F.log(share[0])).otherwise(0)
    strong = (share[1] > 1) & (F.col("toxic") * F.log(share[1]) + clean_part > -math.log(CHANCE))
    found = sorted((bytes(r["feature"]), r["clean"], r["toxic"]) for r in held.filter(strong).collect())
    index = _index([f for f, _, _ in found], np.array([x[1:] for x in found], float).reshape(-1, 2), tried, expected)
    kinds = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_key bigint, label string, bags array<array<int>>, times array<bigint>"
    reduced = in_batches(rows, _reduced(docs.sparkSession.sparkContext.broadcast(index)), kinds)
    chosen = sorted((r.label, r.bags, r.times) for r in one_per_id(reduced).collect())  # at most 2 x per_class rows
    return solve(list(index), [list(zip(bags, times)) for _, bags, times in chosen], [int(label) for label, _, _ in chosen])


def add_scores(docs: DataFrame, model: ToxicityModel, score: str, offending: str) -> DataFrame:
    """``docs`` with its score and its offending sentences (byte ranges of the text) in two new columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    # Arrow functions take columns by name, which a dot or a backtick in it would break: numbers stand in for names.
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = [name.lower() for name in docs.columns].index("text")
    schema = StructType(list(numbered.schema.fields)).add("score", "double").add("offending", OFFENDING)
    return in_batches(numbered, _scored(shared, f"c{at}"), schema).toDF(*docs.columns, score, offending)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, offending.

    A null or empty text has no sentence and scores 0. A row without doc_id is not held out. Only doc_id and text of ``docs`` and doc_id
    and toxic of ``labels`` are read. Repeated rows are scored each on its own; an empty table gives no rows.
    """
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    scored = add_scores(rows, fit_on(docs, labels), "score", "offending")
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns kept."""
    score, offending = free_name(docs, "score"), free_name(docs, "offending")
    scored = add_scores(docs, fit_on(docs, labels), score, offending)
    return scored.filter(F.col(score) < THRESHOLD).select(*map(quoted, docs.columns))
