"""Quality rules: counts of a text, and lines that many documents of a host share, in DataFrame functions only.

The base rules need nothing but the text. The cross-document rule hashes every line in a normal form (blanks at both ends off, runs of blanks
one blank, A-Z lower-cased) and counts, per host, the distinct documents that hold it. Lines of more documents than the host's
limit are removed, and a document of which too little remains is rejected. Documents of one host with equal texts are one document here, since a
copy says nothing about a line; so the result depends on host and text alone.

Texts are read once. What goes on is narrow: counts, and per line a hash and its number of words. Hosts are never a
grouping of their own except for one number per host; lines are counted by (host, line), with partial counts before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name
from tidemark.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW_WORDS = 8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Limits:
    """When a line is too frequent and when a document is rejected.

    A line goes if more than ``line_docs`` documents of its host hold it and these are more than ``line_percent`` percent of the host's documents.
    A document needs ``min_words`` words, at most ``repeat_percent`` percent of them in repeated windows, and ``left_percent`` percent left.
    """

    line_docs: int = 5
    line_percent: int = 2
    min_words: int = 20
    repeat_percent: int = 30
    left_percent: int = 50


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _window_hashes(words: Column, length: int) -> Column:
    """64-bit hash of each window of ``length`` words; an empty array if there are fewer words."""
    none = F.array().cast("array<bigint>")
    starts = F.sequence(F.lit(0), F.size(words) - length)
    return bound(
        F.transform(words, lambda word: F.xxhash64(word)),
        lambda hashes: F.when(
            F.size(hashes) >= length, F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(length))))
        ).otherwise(none),
    )


def _repeated_starts(grams: Column) -> Column:
    """Positions, ascending, of the values of an array that occur more than once."""

    def flagged(ordered):
        def position(pair, k):
            same = (F.get(ordered, k - 1)["gram"] == pair["gram"]) | (F.get(ordered, k + 1)["gram"] == pair["gram"])
            return F.when(same, pair["at"])

        return F.array_sort(F.filter(F.transform(ordered, position), lambda at: at.isNotNull()))

    return bound(F.array_sort(F.transform(grams, lambda gram, at: F.struct(gram.alias("gram"), at.alias("at")))), flagged)


def repeat_words(words: Column, length: int = WINDOW_WORDS) -> Column:
    """Number of words within windows of ``length`` words that come twice or more, all occurrences included.

    Windows are compared by 64-bit hash. Only texts with a repeated window are sorted.
    """
    zero = F.lit(0).cast("long")

    def covered(starts):
        state = F.struct(F.lit(-length).alias("last"), zero.alias("total"))
        step = lambda seen, at: F.struct(at.alias("last"), (seen["total"] + F.least(F.lit(length), at - seen["last"])).alias("total"))
        return F.aggregate(starts, state, step)["total"]

    return bound(
        _window_hashes(words, length),
        lambda grams: F.when(F.size(F.array_distinct(grams)) == F.size(grams), zero).otherwise(covered(_repeated_starts(grams))),
    )


def duplicate_lines(lines: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return bound(
        F.filter(lines, lambda line: F.btrim(line, F.lit(BLANKS)) != ""),
        lambda worded: (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
    )


def normal_line(line: Column) -> Column:
    blanks = F.regexp_replace(F.btrim(line, F.lit(BLANKS)), r"[\x20\x09-\x0D]+", " ")
    return F.translate(blanks, _UPPER, _UPPER.lower())


def hashed_lines(lines: Column) -> Column:
    """(line: hash of the normal form, words) of each line that has a word."""
    described = F.transform(
        lines, lambda line: F.struct(F.xxhash64(normal_line(line)).alias("line"), F.regexp_count(line, F.lit(WORD)).alias("words"))
    )
    return F.filter(described, lambda found: found["words"] > 0)


def measured(docs: DataFrame, host: str) -> DataFrame:
    """Per row: doc_id, host_key, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.xxhash64(docs[f"`{host}`"]).alias("host_key"), text.alias("text"))
    split = rows.select("doc_id", "host_key", "text", words_of(F.col("text")).alias("words"), F.split("text", "\n").alias("all_lines"))
    return split.select(
        "doc_id",
        "host_key",
        F.xxhash64("text").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("all_lines")).alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        hashed_lines(F.col("all_lines")).alias("lines"),
    )


def frequent_lines(texts: DataFrame, limits: Limits) -> DataFrame:
    """(host_key, line) of the lines above their host's limit. ``texts`` has a row per host_key and text_key, with lines."""
    held = texts.select("host_key", F.explode(F.array_distinct("lines.line")).alias("line"))
    counted = held.groupBy("host_key", "line").agg(F.count("*").alias("docs")).filter(F.col("docs") > limits.line_docs)
    sizes = texts.groupBy("host_key").agg(F.count("*").alias("host_docs"))
    return counted.join(sizes, "host_key").filter(F.col("docs") * 100 > F.col("host_docs") * limits.line_percent).select("host_key", "line")


def judged(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed, kept.

    ``n_removed_words`` counts the words of the lines above the limit. Null and empty texts have no words and fail the base rules. A null host is a
    host, and a null doc_id stays; repeated rows each give a row, but are one document in the counts, as are all rows of a host with
    equal texts (compared by 64-bit hash). Only doc_id, text and the host column are read. An empty table gives no rows.
    """
    rows = materialise(measured(docs, host), "measured")
    texts = rows.groupBy("host_key", "text_key").agg(F.first("lines").alias("lines"))
    texts = materialise(texts, "texts")
    found = texts.select("host_key", "text_key", F.inline("lines")).join(frequent_lines(texts, limits), ["host_key", "line"])
    removed = found.groupBy("host_key", "text_key").agg(F.sum("words").cast("long").alias("removed"))
    joined = rows.drop("lines").join(removed, ["host_key", "text_key"], "left")
    n_removed = F.coalesce("removed", F.lit(0).cast("long"))
    few = F.col("n_words") < limits.min_words
    base_failed = few | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - n_removed) < limits.left_percent * F.col("n_words")
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        n_removed.alias("n_removed_words"),
        base_failed.alias("base_failed"),
        (~base_failed & ~depleted).alias("kept"),
    )


def without_frequent_lines(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The kept rows of ``docs``, all columns, their text without the lines above the host's limit; other lines stay as they are.

    The lines of a host above the limit number at most (lines per document) x 100 / ``line_percent``; they go to the texts as one array per host.
    """
    host_name, found_name, list_name = (free_name(docs, f"__{name}") for name in ("host_key", "found", "frequent"))
    rows = materialise(measured(docs, host), "measured")
    texts = materialise(rows.groupBy("host_key", "text_key").agg(F.first("lines").alias("lines")), "texts")
    lists = frequent_lines(texts, limits).groupBy("host_key").agg(F.collect_set("line").alias(list_name))
    quoted = [docs[f"`{name.replace('`', '``')}`"] for name in docs.columns]
    keyed = docs.select(*quoted, F.xxhash64(docs[f"`{host}`"]).alias(host_name))
    joined = keyed.join(lists.withColumnRenamed("host_key", host_name), host_name, "left")
    none = F.array().cast("array<bigint>")
    frequent = F.coalesce(F.col(list_name), none)
    text = F.coalesce(joined["text"], F.lit(""))
    words = F.size(words_of(text))
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(frequent, F.xxhash64(normal_line(line)))), "\n")
    marked = joined.withColumn(found_name, F.struct(words.alias("words"), repeat_words(words_of(text)).alias("repeated"), left.alias("left")))
    found = F.col(found_name)
    enough = (found["words"] >= limits.min_words) & (100 * found["repeated"] <= limits.repeat_percent * found["words"])
    kept = marked.filter(enough & (100 * F.size(words_of(found["left"])) >= limits.left_percent * found["words"]))
    columns = [found["left"].alias(name) if name == "text" else F.col(f"`{name.replace('`', '``')}`") for name in docs.columns]
    return kept.select(*columns)
