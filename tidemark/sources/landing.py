"""CSV landing files and the append-only bronze tables fed from them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.functions._columns import as_list
from tidemark.sources.evolution import fitting_part, parts, read_parts

MIN_LANDED_ROWS = 10
# Quotes are doubled within quotes, and a quoted value may hold newlines. A file with such values can only be read
# from its start, so each file is one task: large tables land as many files.
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"'}
# Stands for a quoted empty value while reading, since an empty field without quotes is null.
_EMPTY = f"\u0001{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names at least one file or folder, on any Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return found is not None and len(found) > 0


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.csv(path, **CSV_OPTIONS).columns


def _with_empty(df: DataFrame) -> DataFrame:
    strings = [field.name for field in df.schema if isinstance(field.dataType, StringType)]
    return df.withColumns({name: F.when(F.col(f"`{name}`") == _EMPTY, "").otherwise(F.col(f"`{name}`")) for name in strings})


def read_series_csv(spark: SparkSession, path: str, schema: StructType, bind: str = "name") -> DataFrame:
    """Files with a header, as the declared columns; unreadable values become null.

    ``bind='name'`` matches header names: columns the file lacks are null, others are left
    out. ``bind='position'`` takes columns in file order whatever the header says.
    """
    if bind == "position":
        return _with_empty(spark.read.csv(path, schema=schema, emptyValue=_EMPTY, **CSV_OPTIONS))
    if bind != "name":
        raise ValueError(f"bind must be 'name' or 'position', got {bind!r}")
    header = _header(spark, path)
    if not header:
        return spark.createDataFrame([], schema)
    # All text first; files under one path must agree on their header.
    text_schema = ", ".join(f"`{name}` string" for name in header)
    text = _with_empty(spark.read.csv(path, schema=text_schema, enforceSchema=False, emptyValue=_EMPTY, **CSV_OPTIONS))
    own = {name.lower(): name for name in header}
    return text.select(
        *[
            (F.col(f"`{own[field.name.lower()]}`") if field.name.lower() in own else F.lit(None))
            .try_cast(field.dataType)
            .alias(field.name)
            for field in schema
        ]
    )


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Files with a header, types guessed from the data (reads it once more)."""
    return spark.read.csv(path, inferSchema=True, **CSV_OPTIONS)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Files that the readers above read back as they were, also values with quotes and newlines."""
    # Writers take control characters at the ends of a value for white space, and trim that unless told otherwise.
    df.write.csv(path, header=True, escape='"', mode=mode, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def stamp(df: DataFrame, source: str, loaded_at=None) -> DataFrame:
    """Add where and when rows were loaded."""
    moment = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return df.withColumn("_source", F.lit(source)).withColumn("_loaded_at", moment)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is taken while it is written, without another scan."""
    rows = Observation(name)
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def append_bronze(df: DataFrame, path: str) -> int:
    """Append to a bronze table and return the rows written. New columns are allowed, and columns of another type than before."""
    observed, rows = counted(df, "bronze_rows")
    observed.write.mode("append").parquet(fitting_part(df.sparkSession, path, df.schema))
    return rows.get["rows"]


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """A bronze table over the union of the columns that its appends had, each in the least type that holds all of its values."""
    return read_parts(spark, path)


def load_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """A bronze table, or None if it is absent or has no rows."""
    if not parts(spark, path):
        return None
    try:
        df = read_bronze(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            return None
        raise
    return None if df.isEmpty() else df


def first_nonempty(candidates: Iterable[DataFrame], by=None) -> DataFrame:
    """The first candidate that has rows; with ``by``, the choice is made for each key.

    The plain choice looks for one row in each candidate, in a single job, so that the losers
    are not read. The choice by key is one lazy plan over all candidates.
    """
    candidates = list(candidates)
    if not candidates:
        raise ValueError("there are no candidates")
    if by is None:
        probes = [df.limit(1).select(F.lit(rank).alias("rank")) for rank, df in enumerate(candidates)]
        found = reduce(DataFrame.unionAll, probes).agg(F.min("rank")).first()[0]
        return candidates[-1 if found is None else found]

    keys = as_list(by)
    ranked = [df.withColumn("__priority", F.lit(rank)) for rank, df in enumerate(candidates)]
    union = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), ranked)
    winners = union.groupBy(*keys).agg(F.min("__priority").alias("__best")).alias("winner")
    # An inner join with the one winner of each key: unlike a semi join it stays above the union, so that there is one join for
    # any number of candidates. Null-safe keys put a shuffle of their own right below the join on both sides, which is the
    # shape in which AQE can split a hot key.
    same_key = reduce(lambda a, b: a & b, [F.col(f"rows.{key}").eqNullSafe(F.col(f"winner.{key}")) for key in keys])
    is_best = same_key & (F.col("rows.__priority") == F.col("winner.__best"))
    return union.alias("rows").join(winners, is_best).select("rows.*").drop("__priority")


def landed_rows(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Records per ``*.csv`` in the landing folder, be it a file or a folder of parts; 0 if one has more fields than the header."""
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{raw_dir}/*.csv")
    found = files.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files)
    counts = [_records(spark, f"{raw_dir}/{name}", name) for name in sorted(status.getPath().getName() for status in found or ())]
    return reduce(DataFrame.unionAll, counts) if counts else spark.createDataFrame([], "file_name string, n_rows bigint")


def _records(spark: SparkSession, path: str, name: str) -> DataFrame:
    width = len(_header(spark, path))
    if not width:
        return spark.range(1).select(F.lit(name).alias("file_name"), F.lit(0).cast("bigint").alias("n_rows"))
    # Read with one field more than the header has: records of the header's width are then marked as too short, and one
    # that fits, or holds a value there, is too long. (Two or more extra fields that are all empty go unseen.)
    extra = f"field_{width}"
    fields = ", ".join(f"field_{i} string" for i in range(width + 1))
    records = spark.read.csv(path, schema=f"{fields}, __short string", columnNameOfCorruptRecord="__short", **CSV_OPTIONS)
    too_long = F.count_if(F.col("__short").isNull() | F.col(extra).isNotNull())
    n_rows = F.when(too_long == 0, F.count(F.lit(1))).otherwise(0)
    return records.agg(n_rows.alias("n_rows")).select(F.lit(name).alias("file_name"), "n_rows")


def gate_rows(file_counts: DataFrame, sources, min_records: int = MIN_LANDED_ROWS) -> DataFrame:
    """(source, n_files, n_rows, passed): does ``<source>_*`` add up to enough rows?

    One pass serves all sources; a source without files does not pass.
    """
    totals = []
    for source in as_list(sources):
        own = F.col("file_name").startswith(f"{source}_")
        totals += [F.count_if(own), F.coalesce(F.sum(F.when(own, F.col("n_rows"))), F.lit(0))]
    counted_files = file_counts.agg(*[total.alias(f"__{i}") for i, total in enumerate(totals)])
    lines = [
        F.struct(
            F.lit(source).alias("source"),
            F.col(f"__{2 * i}").alias("n_files"),
            F.col(f"__{2 * i + 1}").alias("n_rows"),
            (F.col(f"__{2 * i + 1}") >= min_records).alias("passed"),
        )
        for i, source in enumerate(sources)
    ]
    return counted_files.select(F.inline(F.array(*lines)))


def gated_files(spark: SparkSession, raw_dir: str, sources, min_records: int = MIN_LANDED_ROWS) -> dict[str, int]:
    """The records of each landing file of the sources that pass the gate; one row per file comes to the driver."""
    counts = {row.file_name: row.n_rows for row in landed_rows(spark, raw_dir).collect()}
    own = {source: {name: n for name, n in counts.items() if name.startswith(f"{source}_")} for source in sources}
    return {name: n for files in own.values() if sum(files.values()) >= min_records for name, n in files.items()}
