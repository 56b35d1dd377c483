"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import materialise

# Bytes in one Arrow batch: a Python worker holds one batch at a time.
BATCH_BYTES = 4 << 20
# Rows of two numbers that are broadcast: some 50 MB.
BROADCAST_ROWS = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches of about ``BATCH_BYTES`` at most, or one row."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    column = batch.column(name)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id written as text, modulo the number of folds; a row without id is in no fold (null)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not use yet, whatever the letter case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever it contains."""
    return "`" + name.replace("`", "``") + "`"


def known_rows(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` whose doc_id and text are (``left_semi``) or are not (``left_anti``) in ``found`` (doc_id, text_key: XXH64 of the text).

    ``found`` is written aside and counted first. Up to ``BROADCAST_ROWS`` rows it goes to the texts; beyond that both sides are shuffled.
    """
    key_id, key_text = free_name(docs, "found_id"), free_name(docs, "found_text")
    found = materialise(found.select("doc_id", "text_key").distinct().toDF(key_id, key_text), "found")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    same = docs["doc_id"].eqNullSafe(F.col(key_id)) & F.xxhash64(docs["text"]).eqNullSafe(F.col(key_text))
    return docs.join(found, same, how)


def only_columns(df: DataFrame, **columns: str) -> DataFrame:
    """``new=old`` columns of a table whose other columns do not matter."""
    return df.select(*(df[old].alias(new) for new, old in columns.items()))
