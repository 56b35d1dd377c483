"""The bronze append and the keyed upsert fed by new landing files only.

A batch run appends every landing file again each time. Here the stream's checkpoint remembers which files were read, so each is
appended once, also after a failure. The stream itself only lists files; each batch reads its files as a batch run does, by header.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.dedupe import latest_per_key
from tidemark.sources.evolution import parts
from tidemark.sources.landing import append_bronze, read_bronze, read_series_csv, stamp
from tidemark.sources.tables import upsert

# Files in one batch: the most whose names come to the driver at once.
BATCH_FILES = 100


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """The names of CSV files as they arrive below ``path``; their content is not read here."""
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", BATCH_FILES)
    return files.schema("path string, modificationTime timestamp, length long, content binary").load(path).select("path")


def _rows(batch: DataFrame, schema: StructType, source: str) -> DataFrame | None:
    """The batch's files, each read by its own header, stamped like batch loads."""
    paths = sorted(row.path for row in batch.collect())
    if not paths:
        return None
    read = [read_series_csv(batch.sparkSession, path, schema) for path in paths]
    return stamp(reduce(DataFrame.unionByName, read), source)


def append_new(files: DataFrame, bronze_path: str, schema: StructType, source: str, checkpoint: str) -> StreamingQuery:
    """Append all files that are there now and have not been read yet, then stop.

    The rows are ordinary rows of the bronze table, with the name of their batch in ``_batch``: a batch that is repeated
    after a failure finds its rows there.
    """

    def apply(batch: DataFrame, number: int) -> None:
        rows, name = _rows(batch, schema, source), f"{checkpoint}#{number}"
        if rows is None:
            return
        if parts(batch.sparkSession, bronze_path):
            stored = read_bronze(batch.sparkSession, bronze_path)
            if "_batch" in stored.columns and not stored.filter(F.col("_batch") == name).isEmpty():
                return
        append_bronze(rows.withColumn("_batch", F.lit(name)), bronze_path)

    return _run(files, apply, checkpoint)


def upsert_new(files: DataFrame, path: str, schema: StructType, source: str, keys, latest_by, partition_by, checkpoint: str) -> StreamingQuery:
    """Upsert the rows of each batch of new files by key; a batch that is repeated changes nothing."""

    def apply(batch: DataFrame, _: int) -> None:
        rows = _rows(batch, schema, source)
        if rows is not None and not rows.isEmpty():
            upsert(batch.sparkSession, path, latest_per_key(rows, keys, latest_by), keys, partition_by)

    return _run(files, apply, checkpoint)


def _run(files: DataFrame, apply, checkpoint: str) -> StreamingQuery:
    return files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
