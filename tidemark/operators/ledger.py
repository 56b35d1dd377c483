"""Row checks of a partitioned table whose results are kept, so that unchanged partitions are not read again.

A ledger holds, per partition and check, the number of failing rows, for one set of data files and one definition of the check. A report adds them
up; only partitions with files that the ledger does not know, or checks that are new or defined in another way, are scanned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions._columns import as_predicate
from tidemark.operators.suite import RowCheck
from tidemark.sources.landing import path_exists
from tidemark.sources.summaries import fingerprint, folder_of_row, partition_files, read_folders

LEDGER = "fingerprint long, definition string, failures long"


def failing_rows(check: RowCheck) -> Column:
    return check.failing if check.where is None else as_predicate(check.where) & check.failing


def definition(check: RowCheck) -> str:
    """A name for what a check tests; its thresholds are no part of it."""
    return hashlib.blake2b(str(failing_rows(check)).encode(), digest_size=16).hexdigest()


def _known(spark: SparkSession, ledger: str, definitions: Iterable[str], current: dict[int, str]) -> DataFrame:
    """What the ledger holds on the files that are there now."""
    if not path_exists(spark, f"{ledger}/_SUCCESS"):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("definition").isin(*definitions))
    # A number per partition, from the list of files that the driver holds.
    numbers = spark.createDataFrame([(number,) for number in current], "fingerprint long")
    return rows.join(F.broadcast(numbers), "fingerprint", "left_semi").dropDuplicates(["fingerprint", "definition"])


def scan(spark: SparkSession, path: str, schema, folders: dict[str, int], checks: dict[str, RowCheck]) -> DataFrame:
    """Failures of each check in some partitions (folder to fingerprint), from one scan of those partitions."""
    counts = [F.count_if(failing_rows(check)).alias(name) for name, check in checks.items()]
    rows = read_folders(spark, path, schema, folders)
    found = rows.withColumn("__folder", folder_of_row()).groupBy("__folder").agg(*counts)
    numbers = spark.createDataFrame(sorted(folders.items()), "__folder string, fingerprint long")
    lines = [F.struct(F.lit(name).alias("definition"), F.col(name).alias("failures")) for name in checks]
    return found.join(F.broadcast(numbers), "__folder").select("fingerprint", F.inline(F.array(*lines))).select("fingerprint", "definition", "failures")


def run_recorded_checks(spark: SparkSession, path: str, ledger: str, checks: Iterable[RowCheck], schema=None) -> DataFrame:
    """(check_name, failures, status) for row checks on the table at ``path``, recorded in the table at ``ledger``.

    Predicates must depend on nothing but the row (not on the time, say). A partition of the table may be written in any way, as long as
    its files get new names, as Spark gives them. If a run breaks off, what it did not record is scanned by the next one. An empty table has no failures.
    """
    checks = list(checks)
    if not checks:
        raise ValueError("there are no checks to run")
    named = {definition(check): check for check in checks}
    current = {fingerprint(folder, names): folder for folder, names in partition_files(spark, path).items()}
    known = _known(spark, ledger, named, current)
    recorded = {(row.fingerprint, row.definition) for row in known.select("fingerprint", "definition").collect()}  # per partition and check
    missing = {number: {name for name in named if (number, name) not in recorded} for number in current}
    # Partitions that lack the same checks are scanned together: those with new files lack all.
    groups: dict[frozenset, dict[str, int]] = {}
    for number, lacking in missing.items():
        if lacking:
            groups.setdefault(frozenset(lacking), {})[current[number]] = number
    if groups:
        kind = spark.read.option("mergeSchema", True).parquet(path).schema if schema is None else schema
        for lacking, folders in groups.items():
            scan(spark, path, kind, folders, {name: named[name] for name in sorted(lacking)}).coalesce(1).write.mode("append").parquet(ledger)
        known = _known(spark, ledger, named, current)
    totals = spark.createDataFrame([(i, definition(check)) for i, check in enumerate(checks)], "place int, definition string")
    totals = totals.join(known, "definition", "left").groupBy("place").agg(F.coalesce(F.sum("failures"), F.lit(0).cast("long")).alias("failures"))
    status = F.lit(None).cast("string")
    names = F.lit(None).cast("string")
    for i, check in enumerate(checks):
        status = F.when(F.col("place") == i, check.thresholds.status(F.col("failures"))).otherwise(status)
        names = F.when(F.col("place") == i, F.lit(check.name)).otherwise(names)
    return totals.select(names.alias("check_name"), "failures", status.alias("status"))
