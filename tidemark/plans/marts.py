"""Yearly panel, monthly series and lagged comparison over the observation table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.maths import round_scaled
from tidemark.functions.text import trend_label
from tidemark.operators.neighbours import lag_columns
from tidemark.operators.reshape import pivot_fixed

# Indicators and the columns they become.
PANEL_COLUMNS = {
    "selic_mensal": "selic_media",
    "ipca_mensal": "ipca_media",
    "cambio_usd_brl": "cambio_medio",
    "pib_variacao_pct": "pib_variacao_media",
    "desemprego_pct": "desemprego_medio",
    "renda_media_pc": "renda_media_pc",
}
COMPARISON_COLUMNS = {
    "selic_mensal": "selic",
    "ipca_mensal": "ipca",
    "cambio_usd_brl": "cambio",
    "desemprego_pct": "desemprego",
}
COMPARISON_MEANS = {
    "selic": "selic_media",
    "ipca": "ipca_media",
    "cambio": "cambio_medio",
    "desemprego": "desemprego_medio",
}
PANEL_FIRST_YEAR = 2015


def annual_summary(observations: DataFrame, since: int = PANEL_FIRST_YEAR) -> DataFrame:
    """Rounded mean, minimum and maximum, and the number of observations, per year and indicator."""
    recent = observations.filter((F.col("ano") >= since) & F.col("valor").isNotNull())
    return recent.groupBy("ano", "indicador").agg(
        round_scaled(F.avg("valor"), 4).alias("valor_medio"),
        round_scaled(F.min("valor"), 4).alias("valor_min"),
        round_scaled(F.max("valor"), 4).alias("valor_max"),
        F.count(F.lit(1)).alias("n_observacoes"),
    )


def annual_panel(observations: DataFrame, columns: Mapping[str, str] = PANEL_COLUMNS, since: int = PANEL_FIRST_YEAR) -> DataFrame:
    """One row per year, the rounded yearly mean of each indicator as a column."""
    summary = annual_summary(observations, since)
    return pivot_fixed(summary, ["ano"], "indicador", "valor_medio", columns)


def monthly_series(observations: DataFrame) -> DataFrame:
    """Monthly observations with rounded figures and the direction of the yearly change."""
    monthly = observations.filter(F.col("mes").isNotNull() & F.col("valor").isNotNull())
    return monthly.select(
        "indicador",
        "categoria",
        "fonte",
        "ano",
        "mes",
        "periodo",
        round_scaled("valor", 4).alias("valor"),
        "unidade",
        round_scaled("variacao_yoy", 2).alias("variacao_yoy"),
        trend_label("variacao_yoy").alias("tendencia"),
    )


def lagged_comparison(observations: DataFrame, columns: Mapping[str, str] = COMPARISON_COLUMNS, means: Mapping[str, str] = COMPARISON_MEANS) -> DataFrame:
    """Yearly means, and the mean gap between the exchange rate and last month's inflation.

    ``columns`` must yield ``cambio`` and ``ipca``. The lag runs after the pivot to one row
    per calendar month, so a single ordered window over all months is small at any scale.
    """
    return comparison_of(month_rows(observations, columns), means)


def month_rows(observations: DataFrame, columns: Mapping[str, str] = COMPARISON_COLUMNS) -> DataFrame:
    """One row per calendar month, the compared indicators as columns."""
    monthly = observations.filter(F.col("mes").isNotNull() & F.col("valor").isNotNull())
    return pivot_fixed(monthly, ["ano", "mes"], "indicador", "valor", columns)


def comparison_of(months: DataFrame, means: Mapping[str, str] = COMPARISON_MEANS) -> DataFrame:
    """The lagged comparison from one row per calendar month."""
    lagged = lag_columns(months, ["ipca"], ["ano", "mes"], split=False)
    yearly = [round_scaled(F.avg(name), 2).alias(mean) for name, mean in means.items()]
    gap = round_scaled(F.avg(F.col("cambio") - F.col("ipca_lag1")), 2).alias("cambio_vs_ipca_defasado")
    return lagged.groupBy("ano").agg(*yearly, gap)
