from __future__ import annotations

import pytest
from pyspark.sql import functions as F

# Names that the operators use inside; tables may bring columns of these names.
CLASHING = ("score", "shard", "slot", "fp", "key", "row", "label", "rank", "cell", "arc", "part", "text_key", "offending", "probability", "doc", "root")


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with more columns of clashing names."""

    def create(rows, extra=True):
        rows = [(*row, *("en", "src0")[: 4 - len(row)]) if len(row) < 4 else row for row in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
        return df.select("*", *(F.lit("x").alias(name) for name in CLASHING)) if extra else df

    return create


LONG = "word " * 30_000 + "end."


@pytest.fixture
def edge_documents(documents):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and repeated ids."""
    return documents(
        [
            (None, "text without an id that is long enough to be a line", None, None),
            (None, None, None, None),
            (1, None, "en", "src1"),
            (2, "", "en", None),
            (3, " \n\t ", None, "src1"),
            (4, LONG, "en", "src0"),
            (5, "the same text in two documents, the same text", "en", "src0"),
            (6, "the same text in two documents, the same text", "en", "src0"),
            (7, "a repeated row", "de", "src2"),
            (7, "a repeated row", "de", "src2"),
            (8, "one id", "fr", "src3"),
            (8, "and another text", "fr", "src3"),
            (9, "12345 !!! ###", "en", "src0"),
            (10, "ÀÉÎ ñandú Straße 中文字 \U0001f600", "es", "elsewhere"),
        ]
    )


@pytest.fixture
def no_documents(documents):
    return documents([])


@pytest.fixture
def labels(spark):
    def create(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("score", F.lit("x"))

    return create
