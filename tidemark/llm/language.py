"""Language identification with a blended-spectrum presence kernel, Nyström landmarks and kernel ridge regression.

A text is the set of its character n-grams of 1 to ``ORDERS`` letters (lower case, everything else as one blank). The kernel of two
texts is the share of n-grams they have in common, |A and B| / sqrt(|A| |B|), over a vocabulary of n-grams taken from the landmarks.
Landmarks are sampled texts of each language; a text is mapped to its kernel values with them, whitened by the inverse square root of their
own kernel matrix, and one ridge regression per language scores it. Texts are scored in batches: presence matrix x landmark
matrix x coefficients.

The model is fitted on a bounded sample: at most ``PER_CLASS`` rows per language and ``SAMPLE_ROWS`` in all, but one of each language. Tasks
read the whole sampled texts and pass on their sets, first those of the landmarks, then those of all sampled texts within the vocabulary; numpy
solves the regressions from them, a block of texts at a time. Every language that a sampled row has is learned, whatever the number of languages and
the length of their texts. Whole texts are predicted in Spark tasks; a long text is read in parts, whose sets are united.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_of, in_batches, texts
from tidemark.llm.samples import labelled_sample, one_per_id, sampled_rows
from tidemark.session import materialise

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
ORDERS = 4
PER_CLASS = 400
SAMPLE_ROWS = 20_000
LANDMARKS = 24  # per language, or so that there are MOST_LANDMARKS at most
MOST_LANDMARKS = 2048
FIT_ROWS = 512  # texts of one step of the fit
VOCABULARY = 6000
RIDGE = 1e-2
SHARPNESS = 6.0
HASH_BITS = 20
ROWS = 64  # texts in one matrix product
PART = 1 << 18  # letters read at a time


def letters(text: bytes | None):
    """Code points in lower case; each run of ASCII other than letters is one 32. Empty if there is no letter at all."""
    decoded = (text or b"").decode().lower()
    if not any(map(str.isalpha, decoded)):
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(decoded.encode("utf-32-le"), np.uint32)
    codes = np.where((codes < 97) | ((codes > 122) & (codes < 128)), np.uint32(32), codes)
    blank = codes == 32
    return codes[~(blank & np.concatenate(([False], blank[:-1])))]


def grams(codes, orders: int = ORDERS):
    """Hashes (HASH_BITS) of the distinct n-grams."""
    found = []
    for low in range(0, len(codes), PART):
        part = codes[low : low + PART + orders - 1]
        mixed = np.zeros(len(part), np.uint32)
        for n in range(orders):
            size = len(part) - n
            if size <= 0:
                break
            mixed = (mixed[:size] ^ part[n:]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            found.append((mixed * np.uint32(0x85EBCA77 + 2 * n)) >> np.uint32(32 - HASH_BITS))
        if len(found) > 64:
            found = [np.unique(np.concatenate(found))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    places: np.ndarray  # n-gram hash -> place in the vocabulary, or -1
    landmarks: np.ndarray  # vocabulary x landmarks, each column scaled to length 1
    coefficients: np.ndarray  # landmarks x languages


def presence(found: list[np.ndarray], size: int):
    """Row per text: 1 at its places in the vocabulary, scaled to length 1."""
    matrix = np.zeros((len(found), size), np.float32)
    for row, places in zip(matrix, found):
        row[places] = 1
    return matrix / np.maximum(1, np.sqrt(matrix.sum(axis=1, keepdims=True)))


def places_of(vocabulary):
    places = np.full(1 << HASH_BITS, -1, np.int16)
    places[vocabulary] = np.arange(len(vocabulary))
    return places


def within(found, places):
    """Places in the vocabulary of the n-grams that are in it."""
    at = places[found]
    return at[at >= 0]


def vocabulary_of(landmarks: list[np.ndarray]):
    """The most telling n-grams of some sets: those that about half of them hold."""
    counts = np.bincount(np.concatenate(landmarks), minlength=1 << HASH_BITS)
    share = counts / len(landmarks)
    spread = np.where(counts > 0, share * (1 - share) + 1e-9, -1)
    return np.argsort(-spread, kind="stable")[: min(VOCABULARY, int((counts > 0).sum()))]


def solve(landmarks: list[np.ndarray], places, size: int, read: list[np.ndarray], languages: list[str]) -> LanguageModel:
    """One ridge regression per language, from the places in the vocabulary of landmarks and of sampled texts."""
    names = sorted(set(languages))
    columns = presence(landmarks, size).T
    values, vectors = np.linalg.eigh((columns.T @ columns).astype(np.float64))
    whiten = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)
    numbers = np.searchsorted(names, languages)
    products, answers = np.zeros((len(landmarks), len(landmarks))), np.zeros((len(names), len(landmarks)))
    for low in range(0, len(read), FIT_ROWS):
        mapped = presence(read[low : low + FIT_ROWS], size) @ columns @ whiten
        products += mapped.T @ mapped
        answers -= mapped.sum(axis=0)  # every target is -1, but that of the text's own language
        np.add.at(answers, numbers[low : low + FIT_ROWS], 2 * mapped)
    ridge = np.linalg.solve(products + RIDGE * len(read) / len(names) * np.eye(len(landmarks)), answers.T)
    return LanguageModel(names, places, np.ascontiguousarray(columns), (whiten @ ridge).astype(np.float32))


def landmark_count(languages: int) -> int:
    """Landmarks of each language."""
    return max(1, min(LANDMARKS, MOST_LANDMARKS // max(1, languages)))


def fit(documents: list[bytes], languages: list[str]) -> LanguageModel | None:
    """The steps of ``fit_on`` on texts at hand. None without texts that have letters."""
    read = [(grams(codes), language) for text, language in zip(documents, languages) if len(codes := letters(text))]
    if not read:
        return None
    names = sorted({language for _, language in read})
    landmarks = [s for name in names for s in [x for x, language in read if language == name][: landmark_count(len(names))]][:MOST_LANDMARKS]
    vocabulary = vocabulary_of(landmarks)
    places = places_of(vocabulary)
    sets = [within(x, places) for x, _ in read]
    return solve([within(x, places) for x in landmarks], places, len(vocabulary), sets, [language for _, language in read])


def predict(documents: list[bytes | None], model: LanguageModel | None) -> list[tuple[str, float]]:
    """(language, probability) of each text."""
    found = [(UNKNOWN, 0.0)] * len(documents)
    for low in range(0, len(documents), ROWS):
        read = [(i, codes) for i in range(low, min(low + ROWS, len(documents))) if len(codes := letters(documents[i]))]
        if not read or model is None:
            continue
        kernel = presence([within(grams(codes), model.places) for _, codes in read], model.landmarks.shape[0]) @ model.landmarks
        margins = (kernel @ model.coefficients).astype(np.float64)
        odds = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
        best = margins.argmax(axis=1)
        for (i, _), language, p in zip(read, best, odds[np.arange(len(best)), best] / odds.sum(axis=1)):
            found[i] = (model.languages[language], float(p))
    return found


def _predicted(model):
    def rows(batches):
        known = LanguageModel(*model.value) if model.value else None
        for batch in batches:
            found = predict(texts(batch), known)
            columns = [pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score"])

    return rows


def _read(places=None):
    """The n-grams of each text that has letters; with broadcast ``places``, packed, its places in the vocabulary."""

    def rows(batches):
        for batch in batches:
            found = [grams(letters(text)) for text in texts(batch)]
            held = pa.array([len(x) > 0 for x in found])
            if places is None:
                read = pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))
            else:
                read = pa.array([within(x, places.value).tobytes() for x in found], pa.binary())
            kept = ("doc_id", "text_key", "label", "rank")
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), read], [*kept, "grams"]).filter(held)

    return rows


def _vocabulary(landmarks: DataFrame):
    """``vocabulary_of`` the sets in column ``grams``, counted in Spark; at most VOCABULARY numbers come to the driver."""
    sets = landmarks.count()
    share = F.col("holders") / sets
    counted = landmarks.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("holders"))
    telling = counted.orderBy((share * (1 - share) + F.lit(1e-9)).desc(), "gram").limit(VOCABULARY)
    return np.array([row.gram for row in telling.collect()], np.int64)


def fit_on(docs: DataFrame, per_class: int = PER_CLASS) -> LanguageModel | None:
    """Fit on rows with a language outside the held-out fold."""
    known = docs.select(docs["doc_id"].alias("doc_id"), docs["lang"].alias("label")).filter(fold_of("doc_id", FOLDS) != HELD_OUT)
    sample, _ = labelled_sample(known, per_class, SAMPLE_ROWS)
    rows = materialise(sampled_rows(docs, sample), "language_sample")  # read twice below
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {id_kind}, text_key bigint, label string, rank int, grams"
    per_language = landmark_count(rows.select("label").distinct().count())
    sets = materialise(one_per_id(in_batches(rows.filter(F.col("rank") <= per_language), _read(), f"{kinds} array<int>")), "language_landmarks")
    vocabulary = _vocabulary(sets)
    if not len(vocabulary):  # no landmark has letters; other texts may
        sets = one_per_id(in_batches(rows, _read(), f"{kinds} array<int>"))
        vocabulary = _vocabulary(sets)
    if not len(vocabulary):
        return None
    places = places_of(vocabulary)
    packed = one_per_id(in_batches(rows, _read(docs.sparkSession.sparkContext.broadcast(places)), f"{kinds} binary"))
    # At most SAMPLE_ROWS rows, or one per language, of at most 2 x VOCABULARY bytes.
    found = sorted(((row.label, row["rank"], np.frombuffer(row.grams, np.int16)) for row in packed.collect()), key=lambda row: row[:2])
    landmarks = [read for _, rank, read in found if rank <= per_language] or [read for _, _, read in found]
    return solve(landmarks[:MOST_LANDMARKS], places, len(vocabulary), [read for _, _, read in found], [language for language, _, _ in found])


def languages(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    A text that is null, empty or without any letter is ``und`` with score 0; so is every text if no row has a language to learn from. A row
    without doc_id is not held out, and not learned from. Only doc_id, text and, for fitting, lang are read.
    """
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    fitted = fit_on(docs)
    # Plain data: executors need not know the class.
    plain = fitted and (fitted.languages, fitted.places, fitted.landmarks, fitted.coefficients)
    model = docs.sparkSession.sparkContext.broadcast(plain)
    found = in_batches(rows, _predicted(model), f"doc_id {kind}, lang_pred string, score double")
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
