"""Bronze tables whose columns change type between loads.

Parquet files that disagree on a column's type cannot be read as one table. So a load goes to the first part of the table in which no column has
another type; a new part is begun if there is none. Parts are folders next to the table's own, each with a ledger of its column types, and a reader casts
every column to the least type that holds the values of all parts. A load that only adds columns stays in the part it fits.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

LEDGER = "_types.json"
PART = "__types_"
# Whole numbers from narrow to wide, with the digits that they need.
WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def least_common_type(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both; numbers beside fractions become doubles, and what has no other common type text."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= WHOLE.keys():
        return max((a, b), key=lambda kind: WHOLE[type(kind)])
    if kinds <= {*WHOLE, FloatType, DoubleType, DecimalType}:
        if kinds & {FloatType, DoubleType}:
            return DoubleType()
        scale = max(getattr(kind, "scale", 0) for kind in (a, b))
        digits = max(WHOLE.get(type(kind)) or kind.precision - kind.scale for kind in (a, b))
        return DecimalType(digits + scale, scale) if digits + scale <= 38 else DoubleType()
    if kinds <= {DateType, TimestampType, TimestampNTZType}:
        return TimestampType() if TimestampType in kinds else TimestampNTZType()
    if kinds & {ArrayType, MapType, StructType}:
        raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    return StringType()


def common_schema(schemas) -> dict[str, DataType]:
    """Column names, whatever their letter case, with the least common type of all schemas that have them."""
    types: dict[str, tuple[str, DataType]] = {}
    for schema in schemas:
        for field in schema:
            name, known = types.get(field.name.lower(), (field.name, field.dataType))
            types[field.name.lower()] = (name, least_common_type(known, field.dataType))
    return dict(types.values())


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def parts(spark: SparkSession, path: str) -> list[str]:
    """The folders of a table that exist, the first one first."""
    own, files = _path(spark, path)
    others, _ = _path(spark, f"{path}{PART}*")
    found = [path] if files.exists(own) else []
    numbered = [status.getPath().getName().rpartition(PART)[2] for status in files.globStatus(others) or ()]
    return found + [f"{path}{PART}{number}" for number in sorted(map(int, numbered))]


def part_schema(spark: SparkSession, part: str) -> StructType:
    """The columns of a part, from its ledger; a part without one is asked itself."""
    ledger, files = _path(spark, f"{part}/{LEDGER}")
    if files.exists(ledger):
        stream = files.open(ledger)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return StructType.fromJson(json.loads(text))
    return spark.read.option("mergeSchema", True).parquet(part).schema


def _note(spark: SparkSession, part: str, schema: StructType) -> None:
    """The ledger is replaced whole. It is written before the rows: types without rows do no harm."""
    draft, files = _path(spark, f"{part}/{LEDGER}.{uuid.uuid4().hex}")
    ledger, _ = _path(spark, f"{part}/{LEDGER}")
    stream = files.create(draft, True)
    stream.write(bytearray(schema.json().encode()))
    stream.close()
    files.delete(ledger, False)
    files.rename(draft, ledger)


def fitting_part(spark: SparkSession, path: str, schema: StructType) -> str:
    """The part that a load goes to, noted in its ledger."""
    number = 1
    for part in parts(spark, path):
        known = part_schema(spark, part)
        types = {field.name.lower(): field.dataType for field in known}
        if all(types.get(field.name.lower(), field.dataType) == field.dataType for field in schema):
            new = [field for field in schema if field.name.lower() not in types]
            if new or not _path(spark, f"{part}/{LEDGER}")[1].exists(_path(spark, f"{part}/{LEDGER}")[0]):
                _note(spark, part, StructType([*known.fields, *new]))
            return part
        number = max(number, int(part.rpartition(PART)[2]) + 1 if PART in part.removeprefix(path) else 1)
    part = path if not parts(spark, path) else f"{path}{PART}{number}"
    _note(spark, part, StructType(list(schema.fields)))
    return part


def read_parts(spark: SparkSession, path: str, files=None) -> DataFrame:
    """The rows of all parts, or of some ``files`` of them (by part), over the union of their columns in their least common types.

    With one part, nothing is cast.
    """
    found = parts(spark, path) if files is None else [part for part, names in files.items() if names]
    frames = []
    for part in found or [path]:
        reader = spark.read.option("mergeSchema", True)
        frames.append(reader.parquet(part) if files is None else reader.parquet(*files[part]))
    if len(frames) == 1:
        return frames[0]
    types = common_schema(frame.schema for frame in frames)
    cast = []
    for frame in frames:
        own = {name.lower(): name for name in frame.columns}
        columns = [(F.col(f"`{own[name.lower()]}`") if name.lower() in own else F.lit(None)).cast(kind).alias(name) for name, kind in types.items()]
        cast.append(frame.select(*columns))
    rows = cast[0]
    for frame in cast[1:]:
        rows = rows.unionByName(frame)
    return rows
