"""Flattening API payloads into landing rows.

Each function takes a table with one JSON document per row in column ``payload`` and
flattens all documents in parallel. Documents that do not parse yield no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions._columns import as_operand
from tidemark.functions.text import safe_cast

# Payload layouts, and the mark for "no figure".
SGS_ITEM = "data string, valor string"
SIDRA_LAYOUT = (
    "array<struct<resultados: array<struct<series: array<struct<"
    "localidade: struct<nome: string>, serie: map<string, string>>>>>>>"
)
ODATA_LAYOUT = "struct<value: array<struct<VALVALOR: double, VALDATA: string>>>"
NO_FIGURE = "..."
ODATA_FIRST_YEAR = 2010


def _load_time(loaded_at) -> Column:
    if loaded_at is not None:
        return F.lit(loaded_at)
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _figure(column) -> Column:
    return safe_cast(F.nullif(F.nullif(column, F.lit("")), F.lit(NO_FIGURE)), "double")


def _monthly_rows(items: DataFrame, day: Column, value: Column, fonte, indicador, unidade, loaded_at) -> DataFrame:
    dated = items.withColumn("__day", day)
    day = F.col("__day")
    return dated.select(
        as_operand(fonte if isinstance(fonte, Column) else F.lit(fonte)).alias("fonte"),
        (indicador if isinstance(indicador, Column) else F.lit(indicador)).alias("indicador"),
        day.cast("string").alias("data"),
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        value.alias("valor"),
        F.lit(unidade).alias("unidade"),
        _load_time(loaded_at).alias("dt_carga"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, the document in ``payload``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def read_sgs(spark: SparkSession, path: str) -> DataFrame:
    """The items of top-level array documents; a large file is read item by item."""
    return spark.read.schema(SGS_ITEM).json(path, multiLine=True)


def sgs_rows(items: DataFrame, indicador, unidade: str, fonte="bcb", loaded_at=None) -> DataFrame:
    """Landing rows from (data 'dd/mm/yyyy', valor) items; an empty value stays as null."""
    day = F.try_to_date("data", "dd/MM/yyyy")
    return _monthly_rows(items, day, _figure(F.col("valor")), fonte, indicador, unidade, loaded_at)


def flatten_sgs(raw: DataFrame, indicador, unidade: str, fonte="bcb", loaded_at=None) -> DataFrame:
    items = raw.withColumn("__item", F.explode(F.from_json("payload", f"array<struct<{SGS_ITEM}>>")))
    return sgs_rows(items.select("*", "__item.*"), indicador, unidade, fonte, loaded_at)


def flatten_sidra(raw: DataFrame, indicador, unidade: str, fonte: str = "ibge", loaded_at=None) -> DataFrame:
    """Rows of the first series of each document; entries without a figure are dropped.

    Periods are 'YYYY' or 'YYYYQQ' and become 'YYYY' or 'YYYY-Tq'.
    """
    document = F.from_json("payload", SIDRA_LAYOUT)
    result = F.try_element_at(F.try_element_at(document, F.lit(1))["resultados"], F.lit(1))
    serie = F.try_element_at(result["series"], F.lit(1))["serie"]
    entries = raw.select("*", F.explode(serie).alias("__period", "__text")).withColumn("__figure", _figure(F.col("__text")))
    year = safe_cast(F.substring("__period", 1, 4), "int")
    quarter = safe_cast(F.nullif(F.expr("substring(__period, 5)"), F.lit("")), "int")
    # A quarter of 0 counts as none.
    label = F.when(F.coalesce(quarter, F.lit(0)) != 0, F.concat(year.cast("string"), F.lit("-T"), quarter.cast("string")))
    return entries.filter("__figure is not null").select(
        F.lit(fonte).alias("fonte"),
        (indicador if isinstance(indicador, Column) else F.lit(indicador)).alias("indicador"),
        F.coalesce(label, year.cast("string")).alias("periodo"),
        year.alias("ano"),
        quarter.alias("trimestre"),
        F.col("__figure").alias("valor"),
        F.lit(unidade).alias("unidade"),
        _load_time(loaded_at).alias("dt_carga"),
    )


def flatten_sidra_region(raw: DataFrame, indicador, unidade: str, ano, fonte: str = "ibge", loaded_at=None) -> DataFrame:
    """One row per regional series with its first figure; a missing figure stays as null."""
    first = F.try_element_at(F.from_json("payload", SIDRA_LAYOUT), F.lit(1))
    results = raw.select("*", F.explode(first["resultados"]).alias("__result"))
    series = results.select("*", F.explode("__result.series").alias("__series"))
    text = F.try_element_at(F.map_values("__series.serie"), F.lit(1))
    return series.select(
        F.lit(fonte).alias("fonte"),
        (indicador if isinstance(indicador, Column) else F.lit(indicador)).alias("indicador"),
        F.col("__series.localidade.nome").alias("uf"),
        as_operand(ano).cast("int").alias("ano"),
        _figure(text).alias("valor"),
        F.lit(unidade).alias("unidade"),
        _load_time(loaded_at).alias("dt_carga"),
    )


def flatten_odata(
    raw: DataFrame, indicador, unidade: str, fonte="ipea", min_year: int = ODATA_FIRST_YEAR, loaded_at=None
) -> DataFrame:
    """Rows with a value and a readable date from ``min_year`` on."""
    items = raw.select("*", F.explode(F.from_json("payload", ODATA_LAYOUT)["value"]).alias("__item"))
    day = safe_cast(F.substring("__item.VALDATA", 1, 10), "date")
    rows = _monthly_rows(items, day, F.col("__item.VALVALOR"), fonte, indicador, unidade, loaded_at)
    return rows.filter((F.col("ano") >= min_year) & F.col("valor").isNotNull())
