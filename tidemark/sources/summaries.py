"""Key summaries of a partitioned table: which of its partitions may hold a key, without reading them.

Per partition a summary holds the smallest and largest key and a Bloom filter of the keys, cut into words of 64 bits; a key sets all
its bits within one word. Summaries lie in the table's own folder under a name that readers skip. Each is valid for one set of data files: it carries
a fingerprint of their names, which are new with every write. So summaries are only ever appended, a partition that was written by
other means simply has none, and a summary that a broken run did not write costs reading, never a wrong answer.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions._columns import as_list
from tidemark.session import materialise, remove_path
from tidemark.sources.landing import path_exists

FOLDER = "_key_summary"
BITS_PER_KEY = 16
BITS_SET = 6
# Partitions that one scan names in its filter; with more of them the words are joined instead.
NAMED_PARTITIONS = 500
# A table of fewer bytes has no summaries: all of it is read sooner than they are kept.
SMALL_TABLE = 32 << 20


def partition_files(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The data files of a table by folder, from the listing that the driver holds for any scan; no file is opened."""
    files = defaultdict(list)
    for file in spark.read.schema("listed int").parquet(path).inputFiles():
        folder, _, name = unquote(re.sub("^file:/+", "file:/", file)).rpartition("/")
        files[folder].append(name)
    return dict(files)


def folder_of_row() -> Column:
    """The folder of the file that a row was read from, named as in ``partition_files``."""
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "/[^/]*$", "")


def fingerprint(folder: str, names) -> int:
    """A number for one set of files."""
    digest = hashlib.blake2b("\n".join([folder, *sorted(names)]).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


def read_folders(spark: SparkSession, path: str, schema: StructType, folders) -> DataFrame:
    """Some partitions of a table. No other folder is listed or read."""
    folders = sorted(folders)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def table_bytes(spark: SparkSession, path: str) -> int:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jvm_path).getLength()


def _key(keys) -> Column:
    return F.struct(*[F.col(name) for name in keys]).alias("key")


def _word(keys, words: Column) -> Column:
    """The word of the filter that a key belongs to; the number of words is a power of two."""
    return F.xxhash64(*keys).bitwiseAND(words - 1).alias("word")


def _mask(keys) -> Column:
    """The bits of its word that a key sets."""
    bits = F.xxhash64(F.lit("bits"), *keys)
    mask = F.lit(0).cast("bigint")
    for turn in range(BITS_SET):
        place = F.shiftright(bits, 6 * turn).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask.alias("mask")


def _of(df: DataFrame, fingerprints) -> DataFrame:
    """Rows of some fingerprints: by name, so that row groups are skipped, or by a join if there are many."""
    if len(fingerprints) <= NAMED_PARTITIONS:
        return df.filter(F.col("fingerprint").isin(*sorted(fingerprints)) if fingerprints else F.lit(False))
    wanted = df.sparkSession.createDataFrame([(number,) for number in sorted(fingerprints)], "fingerprint long")
    return df.join(wanted, "fingerprint", "left_semi")


class KeySummaries:
    """The summaries of a table as it lies there now. The driver holds a few numbers per partition, as it holds the list of files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path, partition_files(spark, path)
        self.folders = {fingerprint(folder, names): folder for folder, names in self.files.items()}
        self.parts = self._stored("parts")
        self.known, self.schemas = set(), []
        if self.parts is not None and self.folders:
            self.parts = _of(self.parts, set(self.folders)).dropDuplicates(["fingerprint"])
            rows = self.parts.select("fingerprint", "schema").collect()
            self.known = {row.fingerprint for row in rows}
            self.schemas = [StructType.fromJson(json.loads(text)) for text in sorted({row.schema for row in rows})]

    def _stored(self, part: str) -> DataFrame | None:
        folder = f"{self.path}/{FOLDER}/{part}"
        return self.spark.read.parquet(folder) if path_exists(self.spark, f"{folder}/_SUCCESS") else None

    @property
    def without(self) -> set[str]:
        """Folders that have no summary."""
        return {folder for number, folder in self.folders.items() if number not in self.known}

    def schema(self) -> StructType:
        """The union of the columns of all partitions. Only files without a summary are opened."""
        found = list(self.schemas)
        if self.without or not found:
            reader = self.spark.read.option("basePath", self.path).option("mergeSchema", True)
            found.append(reader.parquet(*(sorted(self.without) or [self.path])).schema)
        fields = {field.name: field for schema in reversed(found) for field in schema}
        return StructType(list(fields.values()))

    def may_hold(self, source: DataFrame, keys) -> list[str]:
        """Folders of the partitions that may hold a key of ``source``: those whose summary does not rule it out, and those without a summary.

        No data file is read. Keys outside the range of a partition's keys are ruled out before the filters are looked at, and filters are read only
        for partitions whose range meets that of ``source``.
        """
        keys = as_list(keys)
        if not self.known:
            return sorted(self.without)
        asked = source.select(*keys)
        ends = asked.agg(F.min(_key(keys)).alias("least"), F.max(_key(keys)).alias("most"))
        near = self.parts.filter((F.col("low") <= ends.select("most").scalar()) & (F.col("high") >= ends.select("least").scalar()))
        near = near.select("fingerprint", "low", "high", "words")
        rows = near.collect()  # a row per partition
        if not rows:
            return sorted(self.without)
        near = self.spark.createDataFrame(rows, near.schema)
        sized = F.explode(F.array(*[F.lit(size).cast("bigint") for size in sorted({row.words for row in rows})]))  # powers of two
        probes = asked.distinct().withColumn("words", sized).select("words", _word(keys, F.col("words")), _mask(keys), _key(keys))
        words = _of(self._stored("words"), {row.fingerprint for row in rows}).dropDuplicates(["fingerprint", "word"])
        held = words.join(near, "fingerprint").join(probes, ["words", "word"])
        found = held.filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).filter("key >= low AND key <= high")
        hits = [row.fingerprint for row in found.select("fingerprint").distinct().collect()]
        return sorted({self.folders[number] for number in hits} | self.without)

    def refresh(self, schema: StructType, keys) -> int:
        """Summarise the partitions that have no valid summary; how many there were. Only key columns of those partitions are read."""
        keys, without = as_list(keys), self.without
        if not without:
            return 0
        own = [(folder, number) for number, folder in self.folders.items() if folder in without]
        numbers = self.spark.createDataFrame(sorted(own), "folder string, fingerprint long")
        rows = read_folders(self.spark, self.path, schema, without).select(folder_of_row().alias("folder"), *keys)
        rows = rows.join(F.broadcast(numbers), "folder")  # a row per partition, from the driver
        counted = rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_rows"), F.min(_key(keys)).alias("low"), F.max(_key(keys)).alias("high"))
        needed = F.greatest(F.lit(1), F.ceil(F.col("n_rows") * BITS_PER_KEY / 64))
        words = F.pow(F.lit(2), F.ceil(F.log2(needed))).cast("bigint")
        counted = counted.withColumn("words", words).withColumn("schema", F.lit(schema.json()))
        parts = self.spark.createDataFrame(counted.collect(), counted.schema)  # a row per partition
        sized = rows.join(F.broadcast(parts.select("fingerprint", "words")), "fingerprint")  # a row per partition
        bits = sized.select("fingerprint", _word(keys, F.col("words")), _mask(keys)).groupBy("fingerprint", "word").agg(F.bit_or("mask").alias("bits"))
        # The words first: a partition without a row in ``parts`` has no summary.
        bits.sortWithinPartitions("fingerprint", "word").write.mode("append").parquet(f"{self.path}/{FOLDER}/words")
        parts.write.mode("append").parquet(f"{self.path}/{FOLDER}/parts")
        return len(without)

    def forget_stale(self) -> None:
        """Drop the summaries of files that are gone. If that breaks off, partitions without a summary are read until the next ``refresh``."""
        if not self.known:
            return
        words = materialise(_of(self._stored("words"), self.known).dropDuplicates(["fingerprint", "word"]), "summary-words")
        parts = materialise(self.parts, "summary-parts")
        remove_path(self.spark, f"{self.path}/{FOLDER}")
        words.write.parquet(f"{self.path}/{FOLDER}/words")
        parts.write.parquet(f"{self.path}/{FOLDER}/parts")
