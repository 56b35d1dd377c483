"""Counting two tables side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT_A = "count_a"
COUNT_B = "count_b"
# Parts that rows are dealt to by hash, to be compared by digest.
DIGEST_BUCKETS = 4096


def side_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of each table per distinct row, nulls being equal to each other.

    Both tables must have the same column names. One shuffle serves both sides, after each
    task has counted its own repeats; a join of two grouped tables would take two. Tables
    without columns give a single row with both sizes.
    """
    def tagged(df: DataFrame, in_a: int) -> DataFrame:
        return df.select("*", F.lit(in_a).alias("__a"), F.lit(1 - in_a).alias("__b"))

    both = tagged(a, 1).unionByName(tagged(b, 0))
    sums = [F.coalesce(F.sum(f"__{side}"), F.lit(0)).alias(name) for side, name in (("a", COUNT_A), ("b", COUNT_B))]
    return both.groupBy(*[f"`{name}`" for name in a.columns]).agg(*sums)


def _hashes(df: DataFrame, buckets: int) -> tuple[Column, list[Column]]:
    """The bucket of a row, and two 64-bit hashes of it in halves, so that sums of them stay within 64 bits."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    marked = [*[column.isNull() for column in columns], *columns]  # a hash passes over nulls, and (null, 1) is not (1, null)
    hashes = [F.xxhash64(F.lit(seed), *marked) for seed in ("one", "other")]
    halves = [half for h in hashes for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")))]
    return F.pmod(hashes[0], F.lit(buckets)).cast("int"), halves


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """(__bucket): the parts in which the rows of two tables, with their repeats, are not the same.

    A digest of a part is its number of rows and the sums of their hashes (128 bits), which do not depend on the order of rows. Each task sends one row
    per part at most; that is all that is shuffled. Parts that differ by chance have equal digests with a probability of about 2^-128.
    """
    def digested(df: DataFrame, sign: int) -> DataFrame:
        bucket, halves = _hashes(df, buckets)
        return df.select(bucket.alias("__bucket"), F.lit(sign).alias("__rows"), *[(half * sign).alias(f"__sum{i}") for i, half in enumerate(halves)])

    names = ["__rows", *[f"__sum{i}" for i in range(4)]]
    both = digested(a, 1).unionByName(digested(b, -1)).groupBy("__bucket").agg(*[F.sum(name).alias(name) for name in names])
    return both.filter(reduce(lambda x, y: x | y, [F.col(name) != 0 for name in names])).select("__bucket")


def only_differing(a: DataFrame, b: DataFrame, buckets: int = DIGEST_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables that lie in parts with different digests. If there are none, neither table is read again."""
    differing = F.broadcast(differing_buckets(a, b, buckets))  # ``buckets`` numbers at most

    def chosen(df: DataFrame) -> DataFrame:
        return df.withColumn("__bucket", _hashes(df, buckets)[0]).join(differing, "__bucket", "left_semi").drop("__bucket")

    return chosen(a), chosen(b)
