"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

# Labels whose counts are broadcast; they are counted first.
BROADCAST_LABELS = 100_000


def labelled_sample(labels: DataFrame, per_class: int, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """At most ``per_class`` (doc_id, label) rows of each label, the same ones each time, and the number ``n`` of rows of each label.

    With ``total``, many labels share so many rows, one each at least. ``labels`` has doc_id and label; rows with a null in either are left out,
    and a doc_id with several labels has the smallest.
    """
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").select("doc_id", F.col("label").cast("string").alias("label"))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    counts = materialise(known.groupBy("label").agg(F.count("*").alias("n")), "label_counts")
    labels_found = counts.count()
    if total:
        per_class = max(1, min(per_class, total // max(1, labels_found)))
    # A share of each class that surely holds enough rows, so that the ranking below sees few rows however large the class is. The counts go to the
    # rows, so that a large class is cut down before its rows meet.
    sizes = F.broadcast(counts) if labels_found <= BROADCAST_LABELS else counts
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    near = known.join(sizes, "label").withColumn("place", place).filter(F.col("place") < (2 * per_class + 100) / F.col("n"))
    first = Window.partitionBy("label").orderBy("place", "doc_id")
    return near.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_class).select("doc_id", "label", "rank"), counts


def sampled_rows(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label, rank, text_key) of the sampled documents; a repeated doc_id gives several rows."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    # The sample is bounded, and narrow.
    return rows.join(F.broadcast(sample), "doc_id").withColumn("text_key", F.xxhash64("text"))


def one_per_id(rows: DataFrame) -> DataFrame:
    """The row with the smallest text_key of each doc_id, so that repeated ids are learned from once, and always alike."""
    first = Window.partitionBy("doc_id").orderBy("text_key")
    return rows.withColumn("__turn", F.row_number().over(first)).filter("__turn = 1").drop("__turn")
