"""Turning counted rows back into that many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16


def repeat_rows(df: DataFrame, copies: str, block: int = BLOCK) -> DataFrame:
    """Each row ``copies`` times, without the count column; rows as they are if there is none.

    A count beyond ``block`` is first cut into blocks which are spread over the cluster, so no task has to write out one hot row
    alone. Other rows stay where they are.
    """
    if copies not in df.columns:
        return df
    columns = [f"`{name}`" for name in df.columns if name != copies]
    repeated = F.explode(F.array_repeat(F.lit(True), F.col(copies).cast("int")))
    few = df.filter(F.col(copies).between(1, block)).withColumn("__copy", repeated)
    last_block = F.expr(f"(`{copies}` - 1) div {block}")
    blocks = df.filter(F.col(copies) > block).withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    spread = blocks.repartition(F.xxhash64(*columns, "__block"))
    in_block = F.least(F.lit(block), F.col(copies) - F.col("__block") * block).cast("int")
    many = spread.withColumn("__copy", F.explode(F.array_repeat(F.lit(True), in_block)))
    return few.select(*columns).unionAll(many.select(*columns))
