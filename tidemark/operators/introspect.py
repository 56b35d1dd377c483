"""Small results on the driver, each behind a row limit."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column, as_operand, as_predicate
from tidemark.session import materialise

MAX_DRIVER_ROWS = 10_000
# Buckets of each hash of a sketch; more of them leave fewer values to count.
SKETCH_BUCKETS = 1 << 16


def _order_term(term) -> tuple[Column, bool]:
    """The aggregate of a term and whether it sorts downwards."""
    if isinstance(term, tuple):
        aggregate, direction = term
        return as_operand(aggregate), direction.lower() == "desc"
    if isinstance(term, Column):
        return term, False
    head, _, last = term.strip().rpartition(" ")
    return (F.expr(head), last.lower() == "desc") if last.lower() in ("asc", "desc") else (F.expr(term), False)


def value_frequencies(
    df: DataFrame, column, order_by="count(*) desc", max_records: int | None = None, where=None, place: str | None = None
) -> DataFrame:
    """Distinct values of ``column`` in the order of aggregates, ties by value.

    ``order_by`` is a term or a list of terms: SQL aggregates with an optional asc or desc at the end, Columns, or pairs of a Column and a
    direction; the name of the column itself is a term as well. ``place`` names a column that numbers the values in this order.
    """
    rows = df if where is None else df.filter(as_predicate(where))
    value, keys, order = as_column(column), [], []
    for i, term in enumerate(order_by if isinstance(order_by, list) else [order_by]):
        own = isinstance(column, str) and isinstance(term, str) and re.fullmatch(rf"`?{re.escape(column)}`?(\s+(asc|desc))?", term.strip(), re.IGNORECASE)
        expression, down = (F.max(value), term.strip().lower().endswith(" desc")) if own else _order_term(term)
        keys.append(expression.alias(f"__order{i}"))
        key = F.col(f"__order{i}")
        order.append(key.desc_nulls_last() if down else key.asc_nulls_last())
    order.append(F.col("value").asc_nulls_last())
    counted = rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n_rows"), *keys)
    hidden = [f"__order{i}" for i in range(len(keys))]
    if max_records is not None:
        counted = counted.orderBy(*order).limit(max_records)
        if place:
            counted = counted.withColumn(place, F.row_number().over(Window.orderBy(*order)).cast("bigint"))  # ``max_records`` rows
        return counted.orderBy(*order).drop(*hidden)
    return (numbered(counted, order, place) if place else counted).orderBy(*order).drop(*hidden)


def most_frequent(df: DataFrame, column, max_records: int, where=None, buckets: int = SKETCH_BUCKETS) -> DataFrame:
    """(value, n_rows): the ``max_records`` most frequent values, ties by value, as ``value_frequencies`` gives them, for columns of very many values.

    A count-min sketch (rows per bucket of two hashes) is counted first: each task sends a number per bucket, however many values there are. The values of
    the heaviest buckets are counted exactly, which gives a count that the result reaches in any case. A value is at most as frequent as each of its
    buckets, so only values whose buckets both reach that count are counted in the end. Values of light buckets are never shuffled.
    """
    rows = (df if where is None else df.filter(as_predicate(where))).select(as_column(column).alias("value"))
    places = [F.pmod(F.xxhash64(F.lit(seed), "value"), F.lit(buckets)).cast("int") for seed in range(2)]
    marked = rows.select(F.explode(F.array(*[F.struct(F.lit(seed).alias("seed"), place.alias("bucket")) for seed, place in enumerate(places)])).alias("at"))
    sketch = marked.groupBy("at.seed", "at.bucket").agg(F.count(F.lit(1)).alias("n_rows"))
    sketch = materialise(sketch, "sketch")  # 2 x ``buckets`` rows at most

    def counted(chosen: list[DataFrame]) -> DataFrame:
        left = rows.withColumns({f"__bucket{seed}": place for seed, place in enumerate(places)})
        for seed, found in enumerate(chosen):
            left = left.join(F.broadcast(found.select(F.col("bucket").alias(f"__bucket{seed}"))), f"__bucket{seed}", "left_semi")
        return left.groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))

    by_seed = [sketch.filter(F.col("seed") == seed) for seed in range(2)]
    heaviest = by_seed[0].orderBy(F.desc("n_rows"), "bucket").limit(4 * max_records)
    reached = counted([heaviest]).orderBy(F.desc("n_rows")).limit(max_records).collect()  # ``max_records`` numbers
    least = reached[-1].n_rows if len(reached) == max_records else 1
    candidates = counted([found.filter(F.col("n_rows") >= least) for found in by_seed])
    return candidates.orderBy(F.desc("n_rows"), F.col("value").asc_nulls_last()).limit(max_records)


def numbered(df: DataFrame, order, name: str) -> DataFrame:
    """``df`` with a column that numbers its rows in a total order from 1, without passing them through one task.

    Rows are sorted into ranges, and numbered within each; what the ranges before hold is added to it. The table is written once, when this is called.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    firsts = sizes.select("__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranged.withColumn(name, within).join(F.broadcast(firsts), "__range").withColumn(name, F.col(name) + F.col("__before")).drop("__range", "__before")


def collect_bounded(df: DataFrame, max_rows: int = MAX_DRIVER_ROWS) -> list:
    """All rows, or an error if there are more than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; aggregate further or raise max_rows")
    return rows


def column_values(df: DataFrame | None, column, order_by="count(*) desc", max_records: int | None = None, default=None, where=None, max_rows: int = MAX_DRIVER_ROWS):
    """The values as a list; ``default`` if there are none or there is no table."""
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    values = value_frequencies(df, column, order_by, max_records, where).select("value")
    return [row[0] for row in collect_bounded(values, max_rows)] or default


def single_value(df: DataFrame, default=None):
    """First column of the first row, or ``default`` if there is no row."""
    row = df.select(df.columns[0]).first()
    return default if row is None else row[0]


def as_dict(df: DataFrame, max_rows: int = MAX_DRIVER_ROWS) -> dict[str, tuple]:
    """Column name to tuple of values."""
    rows = collect_bounded(df, max_rows)
    return {name: tuple(row[i] for row in rows) for i, name in enumerate(df.columns)}


def latest(df: DataFrame, order_by) -> DataFrame:
    """The row with the largest ``order_by``."""
    return df.orderBy(as_column(order_by).desc_nulls_last()).limit(1)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.limit(0)
