"""Key summaries: what they rule out, and upserts that read by them."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import summaries, tables

TABLE = "chave string, fonte string, ano int, valor double"
KEYS, PARTS = ["chave"], ["fonte", "ano"]


@pytest.fixture(autouse=True)
def however_small(monkeypatch):
    """Small tables have summaries here too."""
    monkeypatch.setattr(tables, "table_bytes", lambda spark, path: summaries.SMALL_TABLE)


@pytest.fixture
def stored(spark, tmp_path):
    """A table of 8 sources and 4 years with 200 keys each, the years' keys in ranges of their own."""
    path = str(tmp_path / "stored")
    ids = spark.range(6400).select(
        F.format_string("%05d", F.col("id")).alias("chave"),
        F.concat(F.lit("s"), F.col("id") % 8).alias("fonte"),
        (2000 + F.floor(F.col("id") / 1600)).cast("int").alias("ano"),
        F.col("id").cast("double").alias("valor"),
    )
    tables.upsert(spark, path, ids, KEYS, PARTS)
    return path


def read(spark, path, schema=TABLE):
    """The table with its columns in the order of ``schema``; partition columns are read last."""
    names = [field.split()[0] for field in schema.split(", ")]
    return tables.load(spark, path, schema=schema).select(*names)


def folders(spark, path, *keys):
    asked = spark.createDataFrame([(key,) for key in keys], "chave string")
    return [folder.split("/stored/")[1] for folder in summaries.KeySummaries(spark, path).may_hold(asked, KEYS)]


def test_only_partitions_that_may_hold_a_key_are_named(spark, stored):
    assert folders(spark, stored, "00011") == ["fonte=s3/ano=2000"]
    assert folders(spark, stored, "00011", "06399") == ["fonte=s3/ano=2000", "fonte=s7/ano=2003"]
    assert folders(spark, stored, "99999", "") == []
    absent = folders(spark, stored, *[f"{i:05d}x" for i in range(0, 6400, 160)])  # within the ranges, in no partition
    assert len(absent) <= 3


def test_every_key_is_found(spark, stored):
    """A summary may name too many partitions, but never too few."""
    table = tables.load(spark, stored, schema=TABLE)
    for seed in range(3):
        some = table.filter(F.pmod(F.xxhash64(F.lit(seed), "chave"), F.lit(300)) == 0)
        named = set(summaries.KeySummaries(spark, stored).may_hold(some, KEYS))
        holding = {row[0] for row in some.select(summaries.folder_of_row()).collect()}
        assert holding and holding <= named


def test_ruled_out_partitions_are_not_read(spark, stored):
    """The search opens no file of an excluded partition: destroying those files does no harm to it."""
    for file in glob.glob(f"{stored}/fonte=*/ano=*/*.parquet"):
        if "fonte=s3/ano=2000" not in file:
            os.truncate(file, 0)
    batch = spark.createDataFrame([("00011", "s3", 2000, -1.0)], TABLE)
    changes = tables.find_changes(spark, stored, batch, KEYS, PARTS)
    assert [tuple(row) for row in changes.collect()] == [("00011", "s3", 2000, -1.0, ("s3", 2000))]


def test_upserts_with_moved_new_and_equal_rows(spark, stored, rows):
    before = {row.chave: tuple(row) for row in read(spark, stored).collect()}
    batch = [("00011", "s9", 2010, -1.0), ("03000", "s0", 2001, 3.5), ("90000", "s1", 2002, 0.0), ("00012", "s4", 2000, 12.0)]
    files = set(glob.glob(f"{stored}/fonte=*/ano=*/*.parquet"))
    tables.upsert(spark, stored, spark.createDataFrame(batch, TABLE), KEYS, PARTS)
    assert rows(read(spark, stored)) == sorted((before | {row[0]: row for row in batch}).values())
    replaced = {os.path.dirname(file).split("/stored/")[1] for file in files - set(glob.glob(f"{stored}/fonte=*/ano=*/*.parquet"))}
    assert replaced == {"fonte=s3/ano=2000", "fonte=s0/ano=2001", "fonte=s1/ano=2002"}
    assert folders(spark, stored, "90000") == ["fonte=s1/ano=2002"] and folders(spark, stored, "00011") == ["fonte=s9/ano=2010"]


def test_partitions_written_by_other_means_are_read(spark, stored, rows):
    """Rows that came without a summary are found all the same, and have one after the next upsert."""
    other = spark.createDataFrame([("00500x", "s2", 2000, 1.0), ("70000", "new", 1999, 1.0)], TABLE)
    other.write.partitionBy(*PARTS).mode("append").parquet(stored)
    assert folders(spark, stored, "zzz") == ["fonte=new/ano=1999", "fonte=s2/ano=2000"]
    tables.upsert(spark, stored, spark.createDataFrame([("00500x", "s5", 2003, 2.0), ("70000", "new", 1999, 3.0)], TABLE), KEYS, PARTS)
    found = read(spark, stored).filter("chave in ('00500x', '70000')")
    assert rows(found) == [("00500x", "s5", 2003, 2.0), ("70000", "new", 1999, 3.0)]
    assert folders(spark, stored, "zzz") == []


def test_a_refresh_that_breaks_off_costs_reading_only(spark, stored, rows, monkeypatch):
    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(summaries.KeySummaries, "refresh", broken)
        with pytest.raises(RuntimeError):
            tables.upsert(spark, stored, spark.createDataFrame([("00011", "s3", 2000, -1.0)], TABLE), KEYS, PARTS)
    assert folders(spark, stored, "zzz") == ["fonte=s3/ano=2000"]
    tables.upsert(spark, stored, spark.createDataFrame([("00011", "s3", 2000, -2.0)], TABLE), KEYS, PARTS)
    assert rows(read(spark, stored).filter("chave = '00011'")) == [("00011", "s3", 2000, -2.0)]


def test_composite_and_null_keys_and_odd_folders(spark, tmp_path, rows):
    path, schema = str(tmp_path / "odd"), "a int, b string, teil string, v int"
    first = spark.createDataFrame([(1, "x", "a/b c", 1), (1, "y", "ü+%41", 2), (2, "x", None, 3), (None, "x", "a/b c", 4)], schema)
    tables.upsert(spark, path, first, ["a", "b"], ["teil"])
    tables.upsert(spark, path, spark.createDataFrame([(1, "y", "a/b c", 5), (2, "x", "ü+%41", 6)], schema), ["a", "b"], ["teil"])
    assert rows(read(spark, path, schema)) == [(None, "x", "a/b c", 4), (1, "x", "a/b c", 1), (1, "y", "a/b c", 5), (2, "x", "ü+%41", 6)]


def test_older_rows_are_left_out(spark, tmp_path, rows):
    path, schema = str(tmp_path / "loads"), "k int, p int, v int, carga int"
    tables.upsert(spark, path, spark.createDataFrame([(1, 1, 10, 5), (2, 1, 20, None)], schema), ["k"], ["p"])
    batch = spark.createDataFrame([(1, 1, 11, 4), (2, 2, 21, 1), (3, 1, 30, None)], schema)
    tables.upsert(spark, path, batch, ["k"], ["p"], newer_by=["carga"])
    assert rows(read(spark, path, schema)) == [(1, 1, 10, 5), (2, 2, 21, 1), (3, 1, 30, None)]
    tables.upsert(spark, path, spark.createDataFrame([(3, 1, 31, 1), (2, 2, 22, None)], schema), ["k"], ["p"], newer_by=["carga"])
    assert rows(read(spark, path, schema)) == [(1, 1, 10, 5), (2, 2, 21, 1), (3, 1, 31, 1)]


def test_summaries_of_files_that_are_gone(spark, stored):
    for value in (1.5, 2.5):
        tables.upsert(spark, stored, spark.createDataFrame([("00011", "s3", 2000, value)], TABLE), KEYS, PARTS)
    parts = f"{stored}/{summaries.FOLDER}/parts"
    assert spark.read.parquet(parts).count() == 34
    summaries.KeySummaries(spark, stored).forget_stale()
    assert spark.read.parquet(parts).count() == 32
    assert folders(spark, stored, "00011") == ["fonte=s3/ano=2000"]


def test_an_empty_batch(spark, stored):
    tables.upsert(spark, stored, spark.createDataFrame([], TABLE), KEYS, PARTS)
    assert tables.load(spark, stored, schema=TABLE).count() == 6400


def test_small_tables_have_no_summaries(spark, tmp_path, monkeypatch, rows):
    monkeypatch.undo()
    path = str(tmp_path / "small")
    for value in (1.0, 2.0):
        tables.upsert(spark, path, spark.createDataFrame([("a", "x", 1, value)], TABLE), KEYS, PARTS)
        assert not os.path.exists(f"{path}/{summaries.FOLDER}")
    assert rows(read(spark, path)) == [("a", "x", 1, 2.0)]
