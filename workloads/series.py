"""Observation table, marts and dashboard reads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.plans.dashboard import by_year, indicator_names, latest_kpis, series_explorer as explore
from tidemark.plans.marts import annual_panel, annual_summary, lagged_comparison, monthly_series
from tidemark.plans.silver import OBSERVATION_COLUMNS, harmonise, newest_observations, silver, union_series
from workloads.inputs import LOADS_SQL, OBSERVATIONS_SQL, monthly_landing, quarterly_landing, restated, table
from workloads.registry import query

FIRST_YEAR = 1996
PANEL = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "A": "returned"}
MONTHLY = {"1-URGENT": "cambio", "2-HIGH": "ipca", "3-MEDIUM": "selic"}
MEANS = {"selic": "selic_media", "ipca": "ipca_media", "cambio": "cambio_medio"}
KPIS = {"urgent": (1, "", "%"), "high": (2, "R$ ", ""), "returned": (2, "", "%")}


def _landing(spark, sf_dir) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    monthly = monthly_landing(orders).unionByName(restated(orders))
    return {"monetario": monthly, "atividade": quarterly_landing(table(spark, sf_dir, "lineitem"))}


def observations(spark, sf_dir, **options) -> DataFrame:
    return silver(_landing(spark, sf_dir), **options).drop("_silver_at")


def _harmonised(spark, sf_dir) -> DataFrame:
    return union_series(harmonise(df, category) for category, df in _landing(spark, sf_dir).items())


@query(f"WITH {LOADS_SQL} SELECT * EXCLUDE (carga) FROM keyed")
def silver_union(spark, sf_dir):
    return _harmonised(spark, sf_dir).select(*OBSERVATION_COLUMNS)


@query(f"WITH {LOADS_SQL} SELECT * FROM newest")
def silver_dedupe(spark, sf_dir):
    return newest_observations(_harmonised(spark, sf_dir)).select(*OBSERVATION_COLUMNS)


@query(f"WITH {OBSERVATIONS_SQL} SELECT * EXCLUDE (previous_ano) FROM observations")
def silver_yoy(spark, sf_dir):
    return observations(spark, sf_dir)


@query(f"""WITH {OBSERVATIONS_SQL}
SELECT * EXCLUDE (previous_ano, variacao_yoy),
       CASE WHEN previous_ano = ano - 1 THEN variacao_yoy END AS variacao_yoy FROM observations""")
def silver_yoy_strict(spark, sf_dir):
    return observations(spark, sf_dir, strict=True)


@query(f"WITH {OBSERVATIONS_SQL} SELECT * EXCLUDE (previous_ano) FROM observations")
def silver_yoy_chunked(spark, sf_dir):
    return observations(spark, sf_dir, split=True)


SUMMARY_SQL = f"""
  SELECT ano, indicador, round(avg(valor), 4) AS valor_medio, round(min(valor), 4) AS valor_min,
         round(max(valor), 4) AS valor_max, count(*) AS n_observacoes
  FROM observations WHERE ano >= {FIRST_YEAR} AND valor IS NOT NULL GROUP BY ano, indicador
"""


@query(f"WITH {OBSERVATIONS_SQL} {SUMMARY_SQL}")
def mart_summary(spark, sf_dir):
    return annual_summary(observations(spark, sf_dir), FIRST_YEAR)


PANEL_SQL = f"""
  SELECT ano, {", ".join(f"max(CASE WHEN indicador = '{k}' THEN valor_medio END) AS {v}" for k, v in PANEL.items())}
  FROM ({SUMMARY_SQL}) GROUP BY ano
"""


@query(f"WITH {OBSERVATIONS_SQL} {PANEL_SQL}")
def mart_panel(spark, sf_dir):
    return annual_panel(observations(spark, sf_dir), PANEL, FIRST_YEAR)


MONTHLY_MART_SQL = """
  SELECT indicador, categoria, fonte, ano, mes, periodo, round(valor, 4) AS valor, unidade,
         round(variacao_yoy, 2) AS variacao_yoy,
         CASE WHEN variacao_yoy > 0 THEN 'alta' WHEN variacao_yoy < 0 THEN 'queda'
              WHEN variacao_yoy = 0 THEN 'estavel' ELSE 'sem_dado' END AS tendencia
  FROM observations WHERE mes IS NOT NULL AND valor IS NOT NULL
"""


@query(f"WITH {OBSERVATIONS_SQL} {MONTHLY_MART_SQL}")
def mart_monthly(spark, sf_dir):
    return monthly_series(observations(spark, sf_dir))


LAGGED_SQL = f"""
  SELECT ano, {", ".join(f"round(avg({k}), 2) AS {v}" for k, v in MEANS.items())},
         round(avg(cambio - ipca_lag1), 2) AS cambio_vs_ipca_defasado
  FROM (
    SELECT *, lag(ipca) OVER (ORDER BY ano, mes) AS ipca_lag1 FROM (
      SELECT ano, mes,
             {", ".join(f"max(CASE WHEN indicador = '{k}' THEN valor END) AS {v}" for k, v in MONTHLY.items())}
      FROM observations WHERE mes IS NOT NULL AND valor IS NOT NULL GROUP BY ano, mes))
  GROUP BY ano
"""


@query(f"WITH {OBSERVATIONS_SQL} {LAGGED_SQL}")
def mart_lagged(spark, sf_dir):
    return lagged_comparison(observations(spark, sf_dir), MONTHLY, MEANS)


@query(f"WITH {OBSERVATIONS_SQL} SELECT * FROM ({LAGGED_SQL}) ORDER BY ano")
def comparison_read(spark, sf_dir):
    return by_year(mart_lagged(spark, sf_dir))


def _shown(name, decimals, prefix, suffix):
    return f"coalesce('{prefix}' || printf('%.{decimals}f', {name}) || '{suffix}', '–') AS {name}"


@query(f"""WITH {OBSERVATIONS_SQL}
SELECT ano, {", ".join(_shown(name, *how) for name, how in KPIS.items())}
FROM ({PANEL_SQL}) ORDER BY ano DESC LIMIT 1""")
def mart_latest(spark, sf_dir):
    return latest_kpis(mart_panel(spark, sf_dir), KPIS)


EXPLORER_SQL = f"""
  SELECT *, make_date(ano, mes, 1) AS periodo_dt FROM ({MONTHLY_MART_SQL})
  WHERE indicador IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
"""


@query(f"WITH {OBSERVATIONS_SQL} {EXPLORER_SQL}")
def series_explorer(spark, sf_dir):
    return explore(mart_monthly(spark, sf_dir), ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query(f"WITH {OBSERVATIONS_SQL} SELECT *, make_date(ano, mes, 1) AS periodo_dt FROM ({MONTHLY_MART_SQL}) WHERE variacao_yoy IS NOT NULL")
def series_changes(spark, sf_dir):
    return explore(mart_monthly(spark, sf_dir), with_change_only=True)


@query(f"WITH {OBSERVATIONS_SQL} SELECT DISTINCT indicador FROM ({MONTHLY_MART_SQL})")
def series_names(spark, sf_dir):
    return indicator_names(mart_monthly(spark, sf_dir))
