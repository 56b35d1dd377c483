"""Reads behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start
from tidemark.functions.text import format_kpi
from tidemark.operators.introspect import distinct_sorted, latest

# How each headline figure is shown (decimals, prefix, suffix).
KPI_FORMATS = {
    "selic_media": (1, "", "%"),
    "ipca_media": (2, "", "%"),
    "cambio_medio": (2, "R$ ", ""),
    "desemprego_medio": (1, "", "%"),
    "pib_variacao_media": (2, "", "%"),
}


def latest_kpis(panel: DataFrame, formats=KPI_FORMATS) -> DataFrame:
    """The headline figures of the last year, as text."""
    shown = [format_kpi(name, *how).alias(name) for name, how in formats.items()]
    return latest(panel, "ano").select("ano", *shown)


def indicator_names(monthly: DataFrame) -> DataFrame:
    return distinct_sorted(monthly, "indicador")


def series_explorer(monthly: DataFrame, indicators=None, with_change_only: bool = False) -> DataFrame:
    """The chosen indicators (all if none) with a date per row, in order.

    ``with_change_only`` keeps rows that have a yearly change.
    """
    rows = monthly.filter(F.col("indicador").isin(list(indicators))) if indicators else monthly
    if with_change_only:
        rows = rows.dropna(subset=["variacao_yoy"])
    return rows.withColumn("periodo_dt", month_start("ano", "mes")).orderBy("indicador", "ano", "mes")


def by_year(mart: DataFrame) -> DataFrame:
    return mart.orderBy("ano")
