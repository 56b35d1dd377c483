"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. The tokens of the cells are raked: scaled to the target share of each source, then of
each language and each topic, again and again, until all shares hold at once. No cell may give more tokens than it has. A document is then sampled
with the probability that its cell asks for, tokens wanted over tokens there, so that the expected sample meets the targets.

Targets for sources are given, or made from the sources found: their shares of all tokens, flattened by a power below one, so that a source
of a third of all tokens gives way to the others. Cells are the combinations of the listed values (and one for all others), so their number is
bounded by the targets and only their totals reach the driver. Sampling compares the probability with a hash of the row, which is the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, quoted
from tidemark.session import materialise

OTHER = "other"
ROUNDS = 500
TOLERANCE = 1e-9
BUDGET = 0.5
SEED = 17
LANGUAGES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.12, OTHER: 0.03}
TOPICS = {"prose": 0.85, "table": 0.04, "shouting": 0.02, "markup": 0.04, "license": 0.05}
# Sources found that have a target of their own, those with the most tokens; the rest are one value of the axis.
MOST_SOURCES = 256
FLATTEN = 0.5


def topic_of(text: Column) -> Column:
    """``documents`` has no topic; the form of the text stands in for it."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("!! "), "shouting")
        .when(text.rlike(r"###|\$\$\$|%%%|&&&|\*\*\*"), "markup")
        .when(text.rlike("(?i)licen[sc]e"), "license")
        .otherwise("prose")
    )


def token_count(text: Column) -> Column:
    """Words between white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def rake(tokens: np.ndarray, targets: list[np.ndarray], budget: float) -> np.ndarray:
    """Tokens to take from each cell: as near to ``targets`` (shares along each axis) as the cells allow, ``budget`` in all if there is enough.

    Shares of values without tokens are left out and the others scaled up. Where a cell is exhausted it gives all it has.
    """
    wanted = tokens.astype(float)
    budget = min(float(budget), wanted.sum())
    if not budget:
        return np.zeros_like(wanted)
    shares = []
    for axis, target in enumerate(targets):
        held = tokens.sum(axis=tuple(i for i in range(tokens.ndim) if i != axis)) > 0
        share = np.where(held, target, 0)
        shares.append(share / share.sum() if share.sum() else held / held.sum())
    factor = budget / wanted.sum()
    wanted = wanted * factor
    for _ in range(ROUNDS):
        before = wanted.copy()
        for axis, share in enumerate(shares):
            rest = tuple(i for i in range(tokens.ndim) if i != axis)
            now = wanted.sum(axis=rest, keepdims=True)
            goal = np.expand_dims(share * budget, rest)
            wanted = wanted * np.divide(goal, now, out=np.zeros_like(now), where=now > 0)
        wanted = _within(wanted, tokens, budget)
        if np.abs(wanted - before).max() <= TOLERANCE * budget:
            break
    return wanted


def _within(wanted: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """``wanted`` held below ``tokens``; what that takes away is spread over the other cells in proportion."""
    for _ in range(wanted.size):
        full = wanted >= tokens
        wanted = np.where(full, tokens, wanted)
        free = wanted[~full].sum()
        missing = budget - wanted.sum()
        if missing <= TOLERANCE * budget or not free:
            break
        wanted = np.where(full, wanted, wanted * (1 + missing / free))
    return np.minimum(wanted, tokens)


class Mix:
    """Target shares by axis (source, lang, topic), each a mapping from value to share; ``other`` stands for values not listed, nulls included.

    Without ``sources`` they are the flattened shares of the ``MOST_SOURCES`` largest sources found, and of all others together.
    """

    def __init__(
        self,
        sources: Mapping[str, float] | None = None,
        languages: Mapping[str, float] = LANGUAGES,
        topics: Mapping[str, float] = TOPICS,
        budget: float = BUDGET,
    ):
        self.sources, self.languages, self.topics, self.budget = sources, languages, topics, budget

    def axes(self, totals: DataFrame) -> list[dict[str, float]]:
        """Targets of each axis. ``totals`` has source and tokens."""
        sources = found_targets(totals) if self.sources is None else self.sources
        return [{OTHER: 0.0, **axis} for axis in (sources, self.languages, self.topics)]

    def probabilities(self, totals: DataFrame) -> tuple[list[dict[str, float]], DataFrame]:
        """The targets, and (cell, probability) for each cell that has documents; 1 for cells without tokens. ``totals``: source, lang, topic, tokens."""
        axes = self.axes(totals)
        rows = totals.groupBy(cell_of(axes, *map(F.col, ("source", "lang", "topic"))).alias("cell")).agg(F.sum("tokens").alias("tokens"))
        found = {row.cell: row.tokens for row in rows.collect()}  # one row per combination of listed values at most
        names = list(product(*axes))
        tokens = np.array([float(found.get(_name(name), 0)) for name in names]).reshape([len(axis) for axis in axes])
        wanted = rake(tokens, [np.array(list(axis.values())) for axis in axes], self.budget * tokens.sum())
        share = np.divide(wanted, tokens, out=np.ones_like(tokens), where=tokens > 0)
        chosen = [(cell, float(p)) for cell, p in zip(map(_name, names), share.ravel()) if cell in found]
        return axes, totals.sparkSession.createDataFrame(chosen, "cell string, probability double")


def found_targets(totals: DataFrame) -> dict[str, float]:
    """Shares of the largest sources found, by tokens to the power ``FLATTEN``, and of the others together."""
    sources = totals.filter("source IS NOT NULL").groupBy("source").agg(F.sum("tokens").alias("tokens"))
    largest = sources.orderBy(F.desc("tokens"), "source").limit(MOST_SOURCES).collect()
    weights = {row.source: float(row.tokens) ** FLATTEN for row in largest if row.source != OTHER and row.tokens}
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    rest = max(0.0, everything - sum(row.tokens for row in largest if row.source in weights))
    weights[OTHER] = rest**FLATTEN
    total = sum(weights.values())
    return {source: weight / total for source, weight in weights.items()} if total else {OTHER: 1.0}


def _name(values) -> str:
    return "\x1f".join(values)


def cell_of(axes, source: Column, lang: Column, topic: Column) -> Column:
    """Name of the cell of a row."""
    return F.concat_ws("\x1f", *[F.when(value.isin(*axis), value).otherwise(OTHER) for value, axis in zip((source, lang, topic), axes)])


def _totals(rows: DataFrame) -> DataFrame:
    """(source, lang, topic, tokens), written aside: read for the targets and for the cells."""
    return materialise(rows.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")), "totals")


def _chance(docs: DataFrame) -> Column:
    """Uniform in [0, 1) from the id and the text; equal rows are sampled together."""
    return F.pmod(F.xxhash64(F.lit(SEED), docs["doc_id"], docs["text"]), F.lit(1 << 53)) / float(1 << 53)


def _described(docs: DataFrame, topic: Callable[[Column], Column]) -> DataFrame:
    return docs.select(
        docs["doc_id"].alias("doc_id"),
        docs["source"].alias("source"),
        docs["lang"].alias("lang"),
        topic(docs["text"]).alias("topic"),
        token_count(docs["text"]).alias("n_tokens"),
        _chance(docs).alias("chance"),
    )


def mixed(docs: DataFrame, mix: Mix | None = None, topic: Callable[[Column], Column] = topic_of) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, n_tokens, probability, sampled.

    Nulls and values that the targets do not list form ``other``. Null and empty texts have no tokens and the probability of their cell.
    Only doc_id, text, source and lang are read, once; repeated rows are sampled together; an empty table gives no rows.
    """
    rows = materialise(_described(docs, topic), "described")
    axes, cells = (mix or Mix()).probabilities(_totals(rows))
    keyed = rows.withColumn("cell", cell_of(axes, F.col("source"), F.col("lang"), F.col("topic")))
    found = keyed.join(F.broadcast(cells), "cell")  # a row per combination of listed values
    sampled_ = (F.col("chance") < F.col("probability")).alias("sampled")
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", "probability", sampled_)


def sampled(docs: DataFrame, mix: Mix | None = None, topic: Callable[[Column], Column] = topic_of) -> DataFrame:
    """The sampled rows of ``docs``, all columns kept."""
    axes, cells = (mix or Mix()).probabilities(_totals(_described(docs, topic).select("source", "lang", "topic", "n_tokens")))
    cell, probability = free_name(docs, "cell"), free_name(docs, "probability")
    keyed = docs.withColumn(cell, cell_of(axes, docs["source"], docs["lang"], topic(docs["text"])))
    found = keyed.join(F.broadcast(cells.toDF(cell, probability)), cell)  # a row per combination of listed values
    return found.filter(_chance(docs) < F.col(probability)).select(*map(quoted, docs.columns))
