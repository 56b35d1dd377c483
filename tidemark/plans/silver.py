"""The observation table: unlike series on one shape, one row per key, with yearly change."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import composite_key
from tidemark.functions.maths import percent_change
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.neighbours import add_neighbour

OBSERVATION_KEY = "chave"
OBSERVATION_COLUMNS = [
    "chave",
    "fonte",
    "indicador",
    "categoria",
    "periodo",
    "ano",
    "mes",
    "trimestre",
    "valor",
    "unidade",
]
# Which load a row came from: needed to pick the newest one, then dropped.
LOAD_COLUMNS = {"_loaded_at": "timestamp", "dt_carga": "string"}
YOY_KEYS = ("indicador", "mes", "trimestre")


def harmonise(df: DataFrame, categoria: str) -> DataFrame:
    """A landing table of any frequency as observations; rows without a value go."""
    def optional(name: str, data_type: str) -> Column:
        return (F.col(name) if name in df.columns else F.lit(None)).cast(data_type)

    # A table fed from files of both kinds has both columns, each filled in its own rows.
    periods = [F.col(name) for name in ("data", "periodo") if name in df.columns]
    period = F.coalesce(*periods) if periods else F.lit(None).cast("string")
    return df.filter(F.col("valor").isNotNull()).select(
        composite_key("indicador", period).alias("chave"),
        "fonte",
        "indicador",
        F.lit(categoria).alias("categoria"),
        period.alias("periodo"),
        "ano",
        optional("mes", "int").alias("mes"),
        optional("trimestre", "int").alias("trimestre"),
        "valor",
        "unidade",
        *[optional(name, data_type).alias(name) for name, data_type in LOAD_COLUMNS.items()],
    )


def union_series(frames) -> DataFrame:
    frames = list(frames)
    if not frames:
        raise ValueError("no landing table has rows")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def newest_observations(observations: DataFrame) -> DataFrame:
    """One row per key, from the latest load."""
    return latest_per_key(observations, [OBSERVATION_KEY], list(LOAD_COLUMNS))


def yoy(
    df: DataFrame,
    value: str = "valor",
    keys=YOY_KEYS,
    order: str = "ano",
    strict: bool = False,
    split: bool = True,
    ties=("periodo",),
) -> DataFrame:
    """Add ``variacao_yoy``: change in percent against the previous row of the same season.

    ``strict`` accepts only the year just before. ``split=False`` states that groups are small, one row per period of the
    calendar, and makes each group one window.
    """
    ties = [name for name in ties if name in df.columns]
    ordering = [F.col(name).asc_nulls_first() for name in (order, *ties)]
    previous = F.col("__previous")
    shifted = add_neighbour(df, "__previous", [order, value], ordering, keys, split=split)
    change = percent_change(value, previous[value])
    if strict:
        change = F.when(previous[order] == F.col(order) - 1, change)
    return shifted.select(*df.columns, change.alias("variacao_yoy"))


def silver(frames: Mapping[str, DataFrame], strict: bool = False, split: bool = True, built_at=None) -> DataFrame:
    """Observations from landing tables by category."""
    harmonised = [harmonise(df, categoria) for categoria, df in frames.items()]
    newest = newest_observations(union_series(harmonised)).select(*OBSERVATION_COLUMNS)
    moment = F.current_timestamp() if built_at is None else F.lit(built_at).cast("timestamp")
    return yoy(newest, strict=strict, split=split).withColumn("_silver_at", moment)
