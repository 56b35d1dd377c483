"""Values of the row before or after, also where one group is most of the table.

A window hands each group to a single task. Here the table is cut into range-sorted chunks instead, the neighbour is found
inside each chunk, and the few rows at chunk edges are completed from the chunks next to them: the work is spread evenly whatever the
sizes of the groups. Where groups are bounded by what they mean (a calendar, say), ``split=False`` states so and one window does it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column, as_list
from tidemark.session import materialise

# Edge rows that may be broadcast; with more of them the join is left to Spark.
BROADCAST_EDGES = 200_000
# Groups that failing rows are spread over.
SPREAD = 1 << 16


def add_neighbour(df: DataFrame, name: str, columns, order_by, partition_by=(), offset: int = 1, split: bool = True) -> DataFrame:
    """Add struct ``name`` with ``columns`` of the row ``offset`` places back (ahead if negative).

    The struct is null where the group has no such row. ``order_by`` should be total. With ``split`` the table
    is written once to the shared folder, when this is called.
    """
    if offset == 0:
        raise ValueError("offset must not be 0")
    keys = list(partition_by)
    columns, order = as_list(columns), [as_column(term) for term in as_list(order_by)]
    if split:
        return _neighbour_by_chunk(df, name, columns, order, keys, offset)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.lag(F.struct(*columns), offset).over(window))


def _neighbour_by_chunk(df, name, columns, order: list[Column], keys, offset) -> DataFrame:
    original, reach = df.columns, abs(offset)
    ranged = df.repartitionByRange(*keys, *order).withColumn("__chunk", F.spark_partition_id())
    window = Window.partitionBy("__chunk").orderBy(*keys, *order)
    group = F.struct(*keys) if keys else F.lit(0)
    carried = F.struct(group.alias("group"), F.struct(*columns).alias("row"))
    position, size = F.row_number().over(window), F.count(F.lit(1)).over(Window.partitionBy("__chunk"))
    # Chunks and positions are written down once: the edge rows are matched on them below.
    placed = ranged.select("*", position.alias("__position"), size.alias("__size"), F.lag(carried, offset).over(window).alias("__near"))
    edge = (F.col("__position") <= reach) | (F.col("__position") > F.col("__size") - reach)
    placed = materialise(placed.withColumn("__edge", edge), "neighbours")

    # At most 2 * |offset| rows of each chunk. In their order, the row |offset| places away from one that
    # lacks its neighbour is the one it lacks: all rows between the two are edge rows as well.
    edges = placed.filter("__edge").select("__chunk", "__position", "__size", carried.alias("__own"))
    across = F.lag("__own", offset).over(Window.orderBy("__chunk", "__position"))
    lacking = F.col("__position") <= reach if offset > 0 else F.col("__position") > F.col("__size") - reach
    found = edges.select("__chunk", "__position", lacking.alias("__lacking"), across.alias("__across")).filter("__lacking").drop("__lacking")
    chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if 2 * reach * chunks <= BROADCAST_EDGES:
        found = F.broadcast(found)
    joined = placed.join(found, ["__chunk", "__position"], "left")
    near = F.coalesce(F.col("__near"), F.col("__across"))
    return joined.select(*original, F.when(near["group"].eqNullSafe(group), near["row"]).alias(name))


def lag_columns(df: DataFrame, columns, order_by, partition_by=(), n: int = 1, split: bool = True) -> DataFrame:
    """Add ``<column>_lag<n>`` for each column."""
    columns = as_list(columns)
    shifted = add_neighbour(df, "__previous", columns, order_by, partition_by, n, split)
    return shifted.select(*df.columns, *[F.col("__previous")[name].alias(f"{name}_lag{n}") for name in columns])


def counted_rows(df: DataFrame, columns) -> DataFrame:
    """Distinct rows of ``columns`` with their number in ``__count``; a value that fills a third of the table is one row here."""
    return df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("__count"))


def distinct_steps(counted: DataFrame, keys, order_columns, columns, offset: int, fails=None) -> DataFrame:
    """Each row of ``counted`` (see ``counted_rows``) next to its neighbour one place back (``offset`` 1) or ahead (-1), repeats counted.

    Adds struct ``near``, ``copies`` (how many rows stand behind this one) and ``outer`` (whether the neighbour differs). With ``fails``, a function
    from the neighbour to a condition, only failing rows are returned.

    The rows are cut into sorted chunks. A chunk settles all of its rows but one, and passes on those that fail and a summary: its first and last
    row. The summaries, two rows per chunk, settle the rest in their order. One plan without a copy of the table; groups may be of any size.
    """
    if offset not in (1, -1):
        raise ValueError("offset must be 1 or -1")
    keys, order_columns = list(keys), list(order_columns)
    order = [F.col(name).asc_nulls_last() for name in order_columns]
    fails = fails or (lambda near: F.lit(True))
    ranged = counted.repartitionByRange(*keys, *order).withColumn("__chunk", F.spark_partition_id())
    chunk = Window.partitionBy("__chunk").orderBy(*keys, *order)
    own, group = F.struct(*columns), F.struct(*keys) if keys else F.lit(0)
    carried = F.struct(group.alias("group"), own.alias("row"))
    position, size = F.row_number().over(chunk), F.count(F.lit(1)).over(Window.partitionBy("__chunk"))
    placed = ranged.select("*", position.alias("__position"), size.alias("__size"), F.lag(carried, offset).over(chunk).alias("__near"))

    ends = (F.col("__position") == 1) | (F.col("__position") == F.col("__size"))
    lacking = F.col("__position") == (1 if offset > 0 else F.col("__size"))
    near = F.when(F.col("__near")["group"].eqNullSafe(group), F.col("__near")["row"])
    kept = placed.filter(ends | fails(near) | ((F.col("__count") > 1) & fails(own)))
    # The ends of all chunks meet in one group; other failing rows have no part in that and are spread.
    meeting = F.when(ends, 0).otherwise(1 + F.pmod(F.xxhash64(*keys, *order_columns), F.lit(SPREAD)))
    across = F.lag(carried, offset).over(Window.partitionBy(meeting).orderBy("__chunk", "__position"))
    whole = kept.withColumn("__across", across).withColumn("__near", F.when(lacking, F.col("__across")).otherwise(F.col("__near")))

    # Of n equal rows one borders on another value, the rest border on each other.
    edge = F.struct(near.alias("near"), F.lit(1).cast("bigint").alias("copies"), F.lit(True).alias("outer"))
    inner = F.struct(own.alias("near"), (F.col("__count") - 1).alias("copies"), F.lit(False).alias("outer"))
    sides = F.explode(F.when(F.col("__count") > 1, F.array(edge, inner)).otherwise(F.array(edge)))
    stepped = whole.withColumn("__side", sides).select(*keys, *order_columns, "__side.near", "__side.copies", "__side.outer")
    return stepped.filter(fails(F.col("near")))
