"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column, as_list

_RANK = "__rank"


def deduplicate(df: DataFrame, partition_by, order_by) -> DataFrame:
    """The first row of each key in the given order; rows with nulls are kept.

    The ``row_number() = 1`` shape lets Spark keep one row per key in every map task
    before the shuffle, so a key that holds most of the table sends only a few rows.
    """
    keys = [as_column(key) for key in as_list(partition_by)]
    order = [as_column(term) for term in as_list(order_by)]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, first).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys, latest_by) -> DataFrame:
    """The newest row of each key by ``latest_by``, nulls counting as oldest.

    All other orderable columns break ties, so that the winner does not depend on
    which task read a row first.
    """
    keys, latest_by = as_list(keys), as_list(latest_by)
    rest = [
        field.name
        for field in df.schema
        if field.name not in keys + latest_by and field.dataType.typeName() not in ("map", "variant", "interval")
    ]
    return deduplicate(df, keys, [F.col(name).desc_nulls_last() for name in latest_by + rest])
