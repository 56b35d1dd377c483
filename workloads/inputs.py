"""Observation tables derived from orders and line items, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIRST_LOAD = "2024-01-01T00:00:00"
SECOND_LOAD = "2024-02-01T00:00:00"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the file once per session."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def exact_mean(column: str):
    """Mean of two-decimal figures, summed in whole cents so that the order of addition is no matter."""
    return F.sum(F.rint(F.col(column) * 100).cast("bigint")).cast("double") / 100 / F.count(F.lit(1))


def monthly_landing(orders: DataFrame, load: str = FIRST_LOAD) -> DataFrame:
    """Orders as a monthly series per priority."""
    dated = orders.select(
        "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes")
    )
    means = dated.groupBy("o_orderpriority", "ano", "mes").agg(exact_mean("o_totalprice").alias("valor"))
    return means.select(
        F.lit("orders").alias("fonte"),
        F.col("o_orderpriority").alias("indicador"),
        F.make_date("ano", "mes", F.lit(1)).cast("string").alias("data"),
        "ano",
        "mes",
        "valor",
        F.lit("price").alias("unidade"),
        F.lit(load).alias("dt_carga"),
        F.lit(load).cast("timestamp").alias("_loaded_at"),
    )


def quarterly_landing(lineitem: DataFrame, load: str = FIRST_LOAD) -> DataFrame:
    """Line items as a quarterly series per return flag."""
    dated = lineitem.select(
        "l_returnflag", "l_extendedprice", F.year("l_shipdate").alias("ano"), F.quarter("l_shipdate").alias("trimestre")
    )
    means = dated.groupBy("l_returnflag", "ano", "trimestre").agg(exact_mean("l_extendedprice").alias("valor"))
    return means.select(
        F.lit("lineitem").alias("fonte"),
        F.col("l_returnflag").alias("indicador"),
        F.concat_ws("-T", "ano", "trimestre").alias("periodo"),
        "ano",
        "trimestre",
        "valor",
        F.lit("price").alias("unidade"),
        F.lit(load).alias("dt_carga"),
        F.lit(load).cast("timestamp").alias("_loaded_at"),
    )


def restated(orders: DataFrame) -> DataFrame:
    """A later load that restates the series from settled and open orders only."""
    return monthly_landing(orders.filter(F.col("o_orderstatus") != "P"), SECOND_LOAD)


MONTHLY_SQL = """
  SELECT 'orders' AS fonte, o_orderpriority AS indicador,
         CAST(make_date(year(o_orderdate), month(o_orderdate), 1) AS VARCHAR) AS periodo,
         CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
         CAST(NULL AS INTEGER) AS trimestre,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS valor,
         'price' AS unidade, {load} AS carga
  FROM orders WHERE {condition}
  GROUP BY o_orderpriority, year(o_orderdate), month(o_orderdate)
"""
QUARTERLY_SQL = """
  SELECT 'lineitem' AS fonte, l_returnflag AS indicador,
         CAST(year(l_shipdate) AS VARCHAR) || '-T' || CAST(quarter(l_shipdate) AS VARCHAR) AS periodo,
         CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(NULL AS INTEGER) AS mes,
         CAST(quarter(l_shipdate) AS INTEGER) AS trimestre,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS valor,
         'price' AS unidade, 1 AS carga
  FROM lineitem
  GROUP BY l_returnflag, year(l_shipdate), quarter(l_shipdate)
"""
LOADS_SQL = f"""
loads AS (
  SELECT *, 'monetario' AS categoria FROM ({MONTHLY_SQL.format(load=1, condition='true')})
  UNION ALL
  SELECT *, 'monetario' AS categoria FROM ({MONTHLY_SQL.format(load=2, condition="o_orderstatus <> 'P'")})
  UNION ALL
  SELECT *, 'atividade' AS categoria FROM ({QUARTERLY_SQL})
),
keyed AS (SELECT *, indicador || '_' || periodo AS chave FROM loads),
newest AS (
  SELECT * EXCLUDE (carga, place) FROM (
    SELECT *, row_number() OVER (PARTITION BY chave ORDER BY carga DESC) AS place FROM keyed
  ) WHERE place = 1
)
"""
OBSERVATIONS_SQL = f"""
{LOADS_SQL},
stepped AS (
  SELECT *,
         lag(valor) OVER w AS previous, lag(ano) OVER w AS previous_ano
  FROM newest WINDOW w AS (PARTITION BY indicador, mes, trimestre ORDER BY ano NULLS FIRST, periodo NULLS FIRST)
),
observations AS (
  SELECT chave, fonte, indicador, categoria, periodo, ano, mes, trimestre, valor, unidade,
         round((valor - previous) / nullif(abs(previous), 0) * 100, 2) AS variacao_yoy, previous_ano
  FROM stepped
)
"""
