"""Union of tables whose columns differ."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions._columns import as_predicate


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include=(),
    exclude=(),
    source_column_name: str | None = "source_relation",
    where=None,
) -> DataFrame:
    """All rows of the named tables over the union of their columns.

    Columns keep first-seen order, spelling and type; a table without a column gives null.
    ``column_override`` sets the type of single columns.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    if not relations:
        raise ValueError("there are no relations to union")
    included, excluded = {name.lower() for name in include}, {name.lower() for name in exclude}
    override = {name.lower(): data_type for name, data_type in (column_override or {}).items()}

    superset: dict[str, tuple[str, object]] = {}
    for df in relations.values():
        for field in df.schema:
            key = field.name.lower()
            if key in excluded or (included and key not in included):
                continue
            superset.setdefault(key, (field.name, override.get(key, field.dataType)))
    if not superset:
        raise ValueError(f"there are no columns to union in {', '.join(relations)}")

    def shaped(label: str, df: DataFrame) -> DataFrame:
        own = {name.lower(): name for name in df.columns}
        rows = df if where is None else df.filter(as_predicate(where))
        columns = [
            (F.col(f"`{own[key]}`") if key in own else F.lit(None)).cast(data_type).alias(name)
            for key, (name, data_type) in superset.items()
        ]
        source = [F.lit(label).alias(source_column_name)] if source_column_name else []
        return rows.select(*source, *columns)

    return reduce(DataFrame.unionByName, [shaped(label, df) for label, df in relations.items()])


def _like(pattern: str) -> re.Pattern:
    """A case-blind LIKE pattern as a regular expression."""
    marks = {"%": ".*", "_": "."}
    return re.compile("".join(marks.get(char, re.escape(char)) for char in pattern), re.IGNORECASE | re.DOTALL)


def relations_by_pattern(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "", catalog: str | None = None) -> list[str]:
    """Names of catalog tables and views that match LIKE patterns; reads metadata only.

    Temporary views belong to no schema and are matched on the table pattern alone. Another ``catalog`` than the current one is
    searched for its own tables, which are named with it.
    """
    schemas, tables, unwanted = _like(schema_pattern), _like(table_pattern), _like(exclude)
    where, prefix = (f" IN `{catalog}`", f"{catalog}.") if catalog else ("", "")
    found = []
    for database in [row[0] for row in spark.sql(f"SHOW NAMESPACES{where}").collect()]:
        for table in spark.sql(f"SHOW TABLES IN {f'`{catalog}`.' if catalog else ''}`{database}`").collect():
            if not tables.fullmatch(table.tableName) or unwanted.fullmatch(table.tableName):
                continue
            if table.isTemporary:
                if not catalog:
                    found.append(table.tableName)
            elif schemas.fullmatch(database):
                found.append(f"{prefix}{database}.{table.tableName}")
    return sorted(set(found))


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "", catalog: str | None = None) -> list[str]:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude, catalog)


def union_tables(spark: SparkSession, names, **options) -> DataFrame:
    """``union_relations`` over catalog tables."""
    return union_relations({name: spark.table(name) for name in names}, **options)
