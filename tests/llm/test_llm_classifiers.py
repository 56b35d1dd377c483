"""Held-out accuracy and edge cases of the three classifiers."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, quality, simhash, toxicity, winnow

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    positive = np.array(labels) == 1
    return (ranks[positive].sum() - positive.sum() * (positive.sum() + 1) / 2) / (positive.sum() * (~positive).sum())


def held_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def test_toxicity_held_out(tables):
    docs, labels = tables
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    rows = [r for r in rows if r.held_out]
    assert auc([r.score for r in rows], [r.toxic for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.8 and np.mean([r.predicted for r in rows if not r.toxic]) < 0.01


def test_quality_held_out(tables):
    docs, labels = tables
    rows = [r for r in quality.quality(docs, labels).join(labels, "doc_id").collect() if r.held_out]
    assert auc([r.score for r in rows], [r.quality for r in rows]) > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.96
    # Calibrated: the mean probability is near the share of good documents, and the Brier score is small.
    assert abs(np.mean([r.score for r in rows]) - np.mean([r.quality for r in rows])) < 0.03
    assert np.mean([(r.score - r.quality) ** 2 for r in rows]) < 0.03


def test_language_held_out(tables):
    docs, _ = tables
    rows = [r for r in language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()]
    assert all(r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) > 0.99


def test_labels_and_languages_of_the_held_out_fold_are_not_used(documents, labels):
    rows = [(i, f"{'gut' if i % 2 else 'bad'} text number {i} you {'idiot' if i % 2 else 'friend'}") for i in range(200)]
    truth = [(i, i % 2, i % 2) for i in range(200)]
    turned = [(i, 1 - q, 1 - t) if held_out(i, 3, 1) else (i, q, t) for i, q, t in truth]
    docs = documents(rows)
    for score in (toxicity.toxicity, quality.quality):
        a, b = (sorted((r.doc_id, r.score) for r in score(docs, labels(x)).collect()) for x in (truth, turned))
        assert a == b
    a = sorted((r.doc_id, r.lang_pred) for r in language.languages(documents([(i, t, "en" if i % 2 else "de", "s") for i, t in rows])).collect())
    b = sorted(
        (r.doc_id, r.lang_pred)
        for r in language.languages(documents([(i, t, "xx" if held_out(i, 4, 2) else "en" if i % 2 else "de", "s") for i, t in rows])).collect()
    )
    assert a == b


def test_offending_sentences_are_located():
    evidence = toxicity._Evidence({b"idiot": 30.0})
    text = "Éine Sache. You IDIOT! Bye.".encode()
    score, found = toxicity.score_text(text, evidence, toxicity.BIAS)
    assert score > 0.99 and [text[a : a + n].decode().strip() for a, n, _ in found] == ["You IDIOT"]
    assert toxicity.score_text(b"x. " * 1500, evidence, toxicity.BIAS)[0] < 0.3
    assert toxicity.score_text(None, evidence, toxicity.BIAS) == (0.0, [])


def test_noisy_or_learns_single_words():
    texts = [f"a common sentence. another one{' you moron' if i % 2 else ''}. and more of it {i % 5}".encode() for i in range(60)]
    model = toxicity.fit(texts, [i % 2 for i in range(60)])
    evidence = toxicity._Evidence(model.weights)
    scores = [toxicity.score_text(t, evidence, model.bias)[0] for t in texts]
    assert min(scores[1::2]) > 0.7 > 0.1 > max(scores[::2])


def invented(seed, toxic, sentences=40):
    """Sentences of words made from syllables, so that most words are rare; toxic ones hold a toxic word or two."""
    random = np.random.default_rng(seed)
    syllables = ["the", "er", "on", "an", "re", "nd", "ti", "ha", "es", "ing", "ou", "st", "ea", "ly", "wh", "ble"]
    made = [["".join(syllables[i] for i in word[: 1 + word[0] % 3]) for word in words] for words in random.integers(16, size=(sentences, 9, 3)).tolist()]
    for at in random.integers(sentences, size=3) if toxic else ():
        made[at].append(str(random.choice(["idiot", "moron", "scum", "trash"])))
    return ". ".join(map(" ".join, made)).encode()


def test_clean_texts_are_not_toxic_for_their_length():
    labels = [int(i % 5 == 0) for i in range(600)]
    model = toxicity.fit([invented(i, label) for i, label in enumerate(labels)], labels)
    evidence = toxicity._Evidence(model.weights)
    assert all(toxicity.score_text(invented(1000 + i, True), evidence, model.bias)[0] > 0.7 for i in range(20))
    for sentences in (300, 3000, 30_000):
        text = invented(sentences, False, sentences)
        assert toxicity.score_text(text, evidence, model.bias)[0] < 0.1
        assert toxicity.score_text(text.replace(b".", b" "), evidence, model.bias)[0] < 0.1
        assert toxicity.score_text(text + b". " + invented(7, True), evidence, model.bias)[0] > 0.7


def test_toxicity_is_learned_from_long_texts(documents, labels):
    rows = [(i, (invented(i, i % 2) + b". " + invented(1000 + i, False, 400)).decode()) for i in range(120)]
    assert min(len(text) for _, text in rows) > 16_000
    found = toxicity.toxicity(documents(rows), labels([(i, 0, i % 2) for i in range(120)])).collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in found if r.held_out]) > 0.9


def test_context_vectors_are_sums_over_neighbours(monkeypatch):
    monkeypatch.setattr(quality, "TOKENS", 3)
    index, rows = quality.index_vectors(), np.array([5, 9, 5, 7, 9, 9, 1])
    table = np.zeros((quality.BUCKETS + 1, quality.WIDTH), np.int64)
    quality.add_contexts(table, rows, index)
    wanted = np.zeros_like(table)
    for i, row in enumerate(rows):
        for j in range(max(0, i - 2), min(len(rows), i + 3)):
            if i != j:
                wanted[row] += index[rows[j]]
    assert (table == wanted).all()
    assert (np.abs(index[:-1]).sum(axis=1) == quality.NONZERO).all() and not index[-1].any()


def test_word_vectors_do_not_depend_on_partitions(documents):
    docs = documents([(i, f"word{i % 7} and word{i % 5} !! again") for i in range(60)])
    assert np.allclose(quality.word_vectors(docs.repartition(1)), quality.word_vectors(docs.repartition(5)))


def test_letters_and_grams():
    assert "".join(map(chr, language.letters("Ab-- 3Ç".encode()))) == "ab ç"
    assert not len(language.letters(b"123 !!")) and not len(language.letters(None))
    codes = language.letters(("abc déf " * 50).encode())
    assert set(language.grams(codes)) == set(language.grams(codes[:200]))


def test_grams_of_long_texts_are_read_in_parts(monkeypatch):
    codes = language.letters(("the quick brown fox jumps over the lazy dog " * 40).encode())
    whole = set(language.grams(codes))
    monkeypatch.setattr(language, "PART", 16)
    assert set(language.grams(codes)) == whole


def test_edges(edge_documents, no_documents, labels):
    count = edge_documents.count()
    some = labels([(i, i % 2, i % 2) for i in range(1, 11)] + [(None, 1, 1), (5, None, None), (5, 1, 0), (77, 1, 1)])
    for truth in (some, labels([]), labels([(1, 1, 1), (4, 1, 1)])):
        for score in (toxicity.toxicity, quality.quality):
            rows = score(edge_documents, truth).collect()
            assert len(rows) == count and all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in rows)
            assert score(no_documents, truth).collect() == []
    rows = language.languages(edge_documents).collect()
    assert len(rows) == count and {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 9)} == {"und"}
    assert language.languages(no_documents).collect() == []
    kept = toxicity.without_toxic(edge_documents, some)
    assert kept.columns == edge_documents.columns


def test_a_language_found_in_long_texts_only_is_learned(documents):
    words = {"aa": "wolka brimo tash erno", "bb": "quesh lindar ovi pelt", "cc": "zamtu ferrok ilg dossen"}
    rows = []
    for i in range(90):
        lang = sorted(words)[i % 3]
        size = 8000 if lang == "cc" else 30
        rows.append((i, " ".join(np.random.default_rng(i).choice(words[lang].split(), size)), lang, "s"))
    assert min(len(text) for _, text, lang, _ in rows if lang == "cc") > 16_000
    found = {r.doc_id: r for r in language.languages(documents(rows)).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang, _ in rows)


def test_three_hundred_languages(documents, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANDMARKS", 450)
    random = np.random.default_rng(3)
    made = ["".join(chr(97 + c) for c in word) for word in random.integers(26, size=(900, 6)).tolist()]
    rows = [(i, " ".join([*made[3 * (i % 300) : 3 * (i % 300) + 3]] * 4), f"l{i % 300}", "s") for i in range(1500)]
    found = language.languages(documents(rows)).collect()
    assert len({r.lang_pred for r in found}) == 300
    assert np.mean([r.lang_pred == f"l{r.doc_id % 300}" for r in found]) > 0.95


def plain_features(text):
    """The weight-bearing features of each span, from the description."""
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    spans = []
    for sentence in re.split(r"[.!?\n\r]", lowered):
        found = re.findall(r"[a-z\x80-\U0010ffff]+", sentence)
        spans += [found[low : low + toxicity.SPAN] for low in range(0, len(found), toxicity.SPAN)]
    encoded = [[word.encode() for word in span] for span in spans]
    return [[f for word in set(span) for f in [word, *(b"^" + word[:n] for n in (5, 6, 7, 8) if len(word) > n)]] for span in encoded]


def test_toxicity_scores_by_the_formula(documents, labels):
    """Scores recomputed from the fitted weights, one sentence at a time."""
    rows = [(i, invented(i, i % 2).decode() + " Schöne Grüße! ok") for i in range(150)]
    docs, truth = documents(rows), labels([(i, 0, i % 2) for i in range(150)])
    model = toxicity.fit_on(docs, truth)
    assert model.weights
    for r in toxicity.toxicity(docs, truth).collect():
        clean, background = 1.0, 1 / (1 + np.exp(-model.bias))
        for span in plain_features(rows[r.doc_id][1]):
            score = 1 / (1 + np.exp(-model.bias - sum(model.weights.get(f, 0) for f in span)))
            clean *= (1 - score) / (1 - background)
        assert abs(r.score - (1 - clean)) < 1e-9 and r.predicted == (r.score >= 0.7)


def test_the_slope_of_the_likelihood():
    """Training lowers the loss, and nothing nearby does better: the numerical gradient vanishes where weights are free."""
    texts = [invented(i, i % 3 == 0, 10) for i in range(90)]
    y = [int(i % 3 == 0) for i in range(90)]
    names = [b"idiot", b"moron", b"scum", b"trash"]
    index = {name: (i, 1.0) for i, name in enumerate(names)}
    bags = [toxicity._bags(text, index) for text in texts]
    model = toxicity.solve(names, bags, y)

    def loss(weights):
        total = toxicity.SHRINK * sum(weights)
        for label, found in zip(y, bags):
            quiet = np.log1p(np.exp(toxicity.BIAS))
            t = quiet + sum(n * (np.logaddexp(0, toxicity.BIAS + sum(weights[i] for i in bag)) - quiet) for bag, n in found)
            total += t / (2 * (len(y) - sum(y))) if not label else -np.log(-np.expm1(-t)) / (2 * sum(y))
        return total

    weights = np.array([model.weights.get(name, 0.0) for name in names])
    assert loss(weights) < loss(weights * 0.5) and loss(weights) < loss(weights * 0)
    for i in range(len(names)):
        step = np.eye(len(names))[i] * 1e-4
        assert abs(loss(weights + step) - loss(weights - step)) / 2e-4 < 2e-2


def test_quality_scores_by_the_formula(documents, labels):
    rows = [(i, " ".join(f"w{(i * 7 + j) % (11 if i % 2 else 30)}" for j in range(20 + i % 9))) for i in range(80)]
    docs, truth = documents(rows), labels([(i, i % 2, 0) for i in range(80)])
    vectors = quality.word_vectors(docs)
    for r in quality.quality(docs, truth).collect():
        words = [quality.xxhash.xxh32_intdigest(w) % quality.BUCKETS for w in rows[r.doc_id][1].encode().split()]
        found = vectors[words].astype(float)
        alike = sum(float(a @ b) for a, b in zip(found, found[1:])) / (len(words) - 1)
        wanted = np.concatenate((found.mean(axis=0), found.std(axis=0), [alike, np.log1p(len(words)) / 10]))
        assert np.allclose(quality.pooled(rows[r.doc_id][1].encode(), vectors, quality._Buckets()), wanted, atol=1e-4)
        assert r.predicted == (r.score >= 0.5)


def test_models_are_plain_data(spark, documents, labels, monkeypatch):
    """What is broadcast is read by workers that may not have this package: built-in containers, numbers and arrays only."""
    sent = []
    original = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or original(self, value))

    def plain(value):
        if isinstance(value, dict):
            return all(map(plain, [*value.keys(), *value.values()]))
        if isinstance(value, (list, tuple)):
            return all(map(plain, value))
        return value is None or type(value) in (int, float, str, bytes, bool, np.ndarray, np.float64, np.int64)

    rows = [(i, invented(i, i % 2, 5).decode(), "en" if i % 2 else "de", "s") for i in range(60)]
    docs, truth = documents(rows), labels([(i, i % 2, i % 2) for i in range(60)])
    for df in (toxicity.toxicity(docs, truth), quality.quality(docs, truth), language.languages(docs), toxicity.without_toxic(docs, truth)):
        df.count()
    assert len(sent) >= 7 and all(map(plain, sent))


def test_odd_column_names(documents, labels):
    docs = documents([(i, f"text {i}") for i in range(4)]).withColumn("a.b", F.lit(1)).withColumn("c`d", F.lit("x")).withColumn("bad_id", F.lit(1))
    docs = docs.withColumn("kept_id", F.lit(2)).withColumn("copy", F.lit(3))
    items = docs.select(F.lit("i").alias("item_id"), F.lit("nothing of this").alias("text")).limit(1)
    for kept in (toxicity.without_toxic(docs, labels([])), simhash.representatives(docs), winnow.without_contaminated(docs, items)):
        assert kept.columns == docs.columns and kept.count() > 0
