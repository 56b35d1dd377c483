"""Observation tables on disk: load, partitioned write, keyed upsert, export and views."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions._columns import as_list
from tidemark.session import materialise, remove_path, scratch_path
from tidemark.sources.landing import path_exists
from tidemark.sources.summaries import SMALL_TABLE, KeySummaries, folder_of_row, read_folders, table_bytes

# Partitions that one scan names in its filter; more of them take several scans.
PARTITIONS_AT_ONCE = 500


def load(spark: SparkSession, path: str, format: str = "parquet", schema=None) -> DataFrame:
    """A table by path. Without a schema, partition values are typed as their folder names look."""
    reader = spark.read.format(format)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table lies at ``path``."""
    return path_exists(spark, f"{path}/_SUCCESS")


def first_existing_schema(spark: SparkSession, schemas, table: str) -> str | None:
    """The first schema that has ``table``."""
    return next((name for name in schemas if spark.catalog.tableExists(f"{name}.{table}")), None)


def _by_partition(df: DataFrame, columns) -> DataFrame:
    return df.hint("rebalance", *[F.col(name) for name in columns])


def _without_empty(df: DataFrame, columns) -> DataFrame:
    """Empty strings in partition columns as null: both lie in the same folder and are read back as null."""
    strings = [name for name in columns if isinstance(df.schema[name].dataType, StringType)]
    return df.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in strings})


def write_partitioned(df: DataFrame, path: str, partition_by, mode: str = "overwrite") -> None:
    """Write one folder per partition value.

    Rows are rebalanced by partition first: few files per folder, and a partition that is
    much larger than the others is split over several tasks.
    """
    columns = as_list(partition_by)
    _by_partition(_without_empty(df, columns), columns).write.partitionBy(*columns).mode(mode).parquet(path)


def export_parquet(df: DataFrame, path: str) -> None:
    """A full, unpartitioned copy."""
    df.write.mode("overwrite").parquet(path)


def register_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A temporary view over a Parquet folder; partition folders become columns."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> None:
    """Store a query as a catalog table, built aside and then put in place.

    With a ``path`` (a fresh one) the data lies there instead of in the warehouse.
    """
    spark = df.sparkSession
    building, replaced = f"{name}__building", f"{name}__replaced"
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(building)
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {replaced}")  # left by a run that broke off here
        spark.sql(f"ALTER TABLE {name} RENAME TO {replaced}")
    spark.sql(f"ALTER TABLE {building} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {replaced}")


def merge_rows(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """``target`` with the rows of ``source`` in place of rows with the same key, or added.

    Columns that ``source`` lacks keep their stored values; added rows have null there.
    """
    keys = as_list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(_completed(target, source, keys), allowMissingColumns=True)


def _completed(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """``source`` with the stored values of the columns it lacks."""
    lacking = [name for name in target.columns if name not in source.columns]
    return source.join(target.select(*keys, *lacking), keys, "left") if lacking else source


def located_changes(target: DataFrame, source: DataFrame, keys, keep, ignore=(), newer_by=()) -> DataFrame:
    """The rows of ``source`` that are new or differ from the stored row with their key, in columns other than ``ignore``.

    Columns that ``source`` lacks have their stored values. ``__old`` holds the ``keep`` columns of the stored row; it is null for a new row. With
    ``newer_by``, a row that is older than the stored one in these columns (nulls oldest) is no change. Rows that share their key
    with another one are kept, whatever they hold.
    """
    keys = as_list(keys)
    compared = [name for name in source.columns if name not in (*keys, *ignore)]
    known = set(compared) <= set(target.columns)
    lacking = [name for name in target.columns if name not in source.columns]
    stored = {name: F.struct(*names) for name, names in {"__own": compared if known else [], "__load": newer_by, "__rest": lacking}.items() if names}
    sides = target.select(*keys, F.struct(*keep).alias("__old"), *[column.alias(name) for name, column in stored.items()])
    joined = source.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(*keys))).join(sides, keys, "left")
    changed = F.lit(not known)
    if "__own" in stored:
        changed = ~F.col("__own").eqNullSafe(stored["__own"])
    if newer_by:
        changed = changed & (stored["__load"] >= F.col("__load"))
    rows = joined.filter(F.col("__old").isNull() | changed | (F.col("__rows") > 1))
    return rows.select(*source.columns, *[F.col("__rest")[name].alias(name) for name in lacking], "__old")


def reject_repeated_keys(df: DataFrame, keys) -> None:
    """Two source rows for one key would make the outcome a matter of chance."""
    keys = as_list(keys)
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1").select(*keys).first()
    if repeated is not None:
        raise ValueError(f"more than one source row for key {tuple(repeated)}")


def upsert(
    spark: SparkSession, path: str, source: DataFrame, keys, partition_by, format: str = "parquet", ignore=(), newer_by=(), small_table: int = SMALL_TABLE
) -> None:
    """Update or insert ``source`` by key into the partitioned table at ``path``.

    Rows that equal the stored ones (apart from the columns in ``ignore``, say a time stamp) are left alone, and only the
    partitions that receive other rows, or hold their keys now, are rewritten; a key may move to another partition. Columns that ``source``
    lacks keep their values. Keys are unique on both sides. With ``newer_by``, rows older than the stored ones in these columns are left out.

    Where a key lives is looked up in the partitions that may hold it by the table's key summaries (``sources.summaries``); the data files of
    the others are not read. A table of fewer bytes than ``small_table`` is searched whole instead.

    The merged partitions are first completed in the shared folder. What is to happen is then noted in the table's folder,
    done, and the note removed: a run that fails before leaves the table as it was, and one that fails after is completed by the
    next one, or by ``finish_upsert``. Until then a moved key can be read twice.

    ``format='delta'`` passes the rows to a Delta MERGE. That branch is experimental: it has not been run.
    """
    if format == "delta":
        source = materialise(_without_empty(source, as_list(partition_by)), "upsert-source")
        reject_repeated_keys(source, keys)
        _merge_delta(spark, path, source, as_list(keys), as_list(partition_by))
        return
    changes = find_changes(spark, path, source, keys, partition_by, ignore, newer_by)
    apply_changes(spark, path, changes, keys, partition_by, small_table)


def find_changes(
    spark: SparkSession, path: str, source: DataFrame, keys, partition_by, ignore=(), newer_by=(), keep=(), unique: bool = False
) -> DataFrame:
    """What an upsert of ``source`` would change, written aside: rows as they would be stored, with ``__old``, a struct of the partition columns and the
    ``keep`` columns of the stored row, null for a new one. Repeated keys among the changes are refused; ``unique`` states that there are none."""
    keys, columns = as_list(keys), as_list(partition_by)
    source = _without_empty(source, columns)
    finish_upsert(spark, path)
    kept = list(dict.fromkeys([*columns, *keep]))
    if table_exists(spark, path):
        source = materialise(source, "upsert-source")
        summaries = KeySummaries(spark, path)
        candidates = read_folders(spark, path, _typed(summaries.schema(), source, columns), summaries.may_hold(source, keys))
        changes = located_changes(candidates, source, keys, kept, ignore, newer_by)
    else:
        old = StructType([source.schema[name] for name in kept])
        changes = source.withColumn("__old", F.lit(None).cast(old))
    changes = materialise(changes, "upsert-changes")
    if not unique:
        reject_repeated_keys(changes, keys)
    return changes


def apply_changes(spark: SparkSession, path: str, changes: DataFrame, keys, partition_by, small_table: int = SMALL_TABLE) -> None:
    """Store what ``find_changes`` found, and summarise the keys of the partitions that were written unless the table is small."""
    keys, columns = as_list(keys), as_list(partition_by)
    rows = changes.drop("__old")
    if not table_exists(spark, path):
        write_partitioned(rows, path, columns)
    elif changes.isEmpty():
        return
    else:
        schema = _typed(KeySummaries(spark, path).schema(), rows, columns)
        _replace_partitions(spark, path, schema, changes, keys, columns)
    if table_bytes(spark, path) >= small_table:
        written = KeySummaries(spark, path)
        written.refresh(_typed(written.schema(), rows, columns), keys)


def _merge_delta(spark, path, source, keys, columns) -> None:
    if not path_exists(spark, f"{path}/_delta_log"):
        source.write.format("delta").partitionBy(*columns).save(path)
        return
    same_key = " AND ".join(f"t.`{key}` = s.`{key}`" for key in keys)
    spark.sql(
        f"MERGE INTO delta.`{path}` t USING {{source}} s ON {same_key} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
        source=source,
    )


def _replace_partitions(spark, path, schema, changes, keys, columns) -> None:
    rows = changes.drop("__old")
    target = spark.read.schema(schema).parquet(path)
    before = changes.filter("__old IS NOT NULL").select(*[F.col("__old")[name].alias(name) for name in columns])
    # One row per partition; the driver holds the table's list of files in any case.
    touched = [tuple(row) for row in rows.select(*columns).union(before).distinct().collect()]

    merged_path = scratch_path(spark, "upsert-merged")
    for chosen in _filters(touched, columns):  # literal values, so that only these partitions are scanned
        kept = target.filter(chosen).join(rows.select(*keys), keys, "left_anti")
        kept.unionByName(rows.filter(chosen), allowMissingColumns=True).write.mode("append").parquet(merged_path)
    held = {tuple(row) for row in spark.read.parquet(merged_path).select(*columns).distinct().collect()}
    emptied = [values for values in touched if values not in held]
    stale = [folder for chosen in _filters(emptied, columns) for folder in _folders(target.filter(chosen))]
    _write_note(spark, path, {"merged": merged_path, "columns": columns, "stale": stale})
    finish_upsert(spark, path)


NOTE = "_unfinished_upsert.json"


def finish_upsert(spark: SparkSession, path: str) -> bool:
    """Complete an upsert that was noted but broke off; whether there was one. Doing it twice changes nothing."""
    note = f"{path}/{NOTE}"
    if not path_exists(spark, note):
        return False
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(note)  # names with an underscore are hidden from Spark's readers
    stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(jvm_path)
    todo = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    publish(spark.read.parquet(todo["merged"]), path, todo["columns"])
    for folder in todo["stale"]:
        remove_path(spark, folder)
    remove_path(spark, note)
    remove_path(spark, todo["merged"])
    return True


def _write_note(spark: SparkSession, path: str, note: dict) -> None:
    """The note appears whole or not at all: written under another name, then renamed."""
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{NOTE}.draft")
    files = draft.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(draft, True)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()
    files.rename(draft, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{NOTE}"))


def _typed(stored: StructType, source: DataFrame, columns) -> StructType:
    """A table's schema with partition values typed as in ``source``, not as guessed from folder names."""
    types = {name: source.schema[name].dataType for name in columns}
    return StructType([StructField(field.name, types.get(field.name, field.dataType)) for field in stored])


def _any(conditions):
    """Conditions joined by OR in a balanced tree, so that a long list stays shallow."""
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def _filters(partitions, columns):
    """Conditions on the partition columns, each for a part of the list."""
    for low in range(0, len(partitions), PARTITIONS_AT_ONCE):
        yield _any(
            [
                reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(columns, values)])
                for values in partitions[low : low + PARTITIONS_AT_ONCE]
            ]
        )


def _folders(df: DataFrame) -> list[str]:
    """Folders of the files behind ``df``; at most one per partition."""
    return [row[0] for row in df.select(folder_of_row().alias("folder")).distinct().collect()]


def publish(df: DataFrame, path: str, partition_by) -> None:
    """Replace just the partitions that ``df`` holds."""
    columns = as_list(partition_by)
    writer = _by_partition(df, columns).write.partitionBy(*columns).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
