"""Payloads, landing files, bronze tables and table writes, all made from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.plans import medallion
from tidemark.session import materialise, scratch_path
from tidemark.sources import candidates, landing, payloads, tables
from tidemark.sources.schemas import GDP_FIELDS, SERIES_SCHEMA
from workloads.inputs import FIRST_LOAD, monthly_landing, quarterly_landing, table
from workloads.registry import query

LANDING_COLUMNS = [name for name in SERIES_SCHEMA.names]


def _order_parts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
    )


# --- payloads: one document per order ---


@query(f"""
SELECT 'bcb' AS fonte, o_orderpriority AS indicador, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data,
       CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
       CASE WHEN item = 1 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor,
       'R$' AS unidade, '{FIRST_LOAD}' AS dt_carga
FROM orders CROSS JOIN (SELECT unnest([1, 2]) AS item)
""")
def payload_sgs(spark, sf_dir):
    day = F.date_format("day", "dd/MM/yyyy").alias("data")
    items = F.array(F.struct(day, F.col("price").alias("valor")), F.struct(day, F.lit("").alias("valor")))
    documents = _order_parts(spark, sf_dir).select("priority", F.to_json(items).alias("payload"))
    return payloads.flatten_sgs(documents, F.col("priority"), "R$", loaded_at=FIRST_LOAD)


@query(f"""
SELECT 'ibge' AS fonte, o_orderpriority AS indicador,
       CASE WHEN item = 1 THEN CAST(year(o_orderdate) AS VARCHAR)
            ELSE CAST(year(o_orderdate) AS VARCHAR) || '-T' || CAST(quarter(o_orderdate) AS VARCHAR) END AS periodo,
       CAST(year(o_orderdate) AS INTEGER) AS ano,
       CASE WHEN item = 2 THEN CAST(quarter(o_orderdate) AS INTEGER) END AS trimestre,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor, '%' AS unidade, '{FIRST_LOAD}' AS dt_carga
FROM orders CROSS JOIN (SELECT unnest([1, 2]) AS item)
""")
def payload_sidra(spark, sf_dir):
    year = F.date_format("day", "yyyy")
    quarter = F.concat(year, F.lit("0"), F.quarter("day").cast("string"))
    serie = F.create_map(
        year, F.col("price"), quarter, F.col("price"), F.concat(year, F.lit("05")), F.lit("..."), F.concat(year, F.lit("06")), F.lit("")
    )
    documents = _order_parts(spark, sf_dir).select("priority", _sidra_document(F.array(_sidra_series("priority", serie))))
    return payloads.flatten_sidra(documents, F.col("priority"), "%", loaded_at=FIRST_LOAD)


def _sidra_series(place: str, serie):
    return F.struct(F.struct(F.col(place).alias("nome")).alias("localidade"), serie.alias("serie"))


def _sidra_document(series):
    return F.to_json(F.array(F.struct(F.array(F.struct(series.alias("series"))).alias("resultados")))).alias("payload")


@query(f"""
SELECT 'ibge' AS fonte, 'populacao' AS indicador, CASE WHEN item = 1 THEN o_orderpriority ELSE o_orderstatus END AS uf,
       CAST(year(o_orderdate) AS INTEGER) AS ano,
       CASE WHEN item = 1 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor,
       'pessoas' AS unidade, '{FIRST_LOAD}' AS dt_carga
FROM orders CROSS JOIN (SELECT unnest([1, 2]) AS item)
""")
def payload_sidra_region(spark, sf_dir):
    year = F.date_format("day", "yyyy")
    known = _sidra_series("priority", F.create_map(year, F.col("price"), F.concat(year, F.lit("x")), F.lit("1")))
    unknown = _sidra_series("status", F.create_map(year, F.lit("...")))
    documents = _order_parts(spark, sf_dir).select(F.year("day").alias("ano"), _sidra_document(F.array(known, unknown)))
    return payloads.flatten_sidra_region(documents, "populacao", "pessoas", "ano", loaded_at=FIRST_LOAD)


@query(f"""
SELECT 'ipea' AS fonte, o_orderpriority AS indicador, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data,
       CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
       o_totalprice AS valor, '%' AS unidade, '{FIRST_LOAD}' AS dt_carga
FROM orders WHERE year(o_orderdate) >= 1997
""")
def payload_odata(spark, sf_dir):
    day = F.date_format("day", "yyyy-MM-dd'T'HH:mm:ss'-03:00'")
    value, when = F.col("amount").alias("VALVALOR"), day.alias("VALDATA")
    no_value, no_day, bad_day = F.lit(None).cast("double").alias("VALVALOR"), F.lit("").alias("VALDATA"), F.lit("n/a").alias("VALDATA")
    items = F.array(F.struct(value, when), F.struct(no_value, when), F.struct(value, no_day), F.struct(value, bad_day))
    document = F.to_json(F.struct(items.alias("value")), {"ignoreNullFields": "false"}).alias("payload")
    documents = _order_parts(spark, sf_dir).select("priority", document)
    return payloads.flatten_odata(documents, F.col("priority"), "%", min_year=1997, loaded_at=FIRST_LOAD)


# --- fallback between sources ---


@query("""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def source_fallback(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    candidates = [orders.filter(F.col("o_orderstatus") == status).drop("o_orderstatus") for status in ("missing", "F", "O")]
    return landing.first_nonempty(candidates)


@query("""
WITH ranked AS (
  SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS priority FROM orders)
SELECT o_custkey, o_orderkey FROM (SELECT *, min(priority) OVER (PARTITION BY o_custkey) AS best FROM ranked)
WHERE priority = best
""")
def source_fallback_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    candidates = [orders.filter(F.col("o_orderstatus") == status).drop("o_orderstatus") for status in ("P", "F", "O")]
    return landing.first_nonempty(candidates, by=["o_custkey"])


# --- landing files ---

MONTHLY_FILE_SQL = f"""
  SELECT 'orders' AS fonte, o_orderpriority AS indicador, ano, mes,
         CAST(make_date(ano, mes, 1) AS VARCHAR) AS data, valor, 'price' AS unidade, '{FIRST_LOAD}' AS dt_carga
  FROM (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS valor
        FROM orders GROUP BY ALL)
"""


def _landed_csv(spark, sf_dir, label: str) -> str:
    path = scratch_path(spark, label)
    landing.write_csv(monthly_landing(table(spark, sf_dir, "orders")).select(*LANDING_COLUMNS), path)
    return path


@query(f"SELECT *, CAST(NULL AS VARCHAR) AS periodo, CAST(NULL AS INTEGER) AS trimestre FROM ({MONTHLY_FILE_SQL})")
def csv_by_name(spark, sf_dir):
    return landing.read_series_csv(spark, _landed_csv(spark, sf_dir, "csv"), GDP_FIELDS)


@query(MONTHLY_FILE_SQL)
def csv_by_position(spark, sf_dir):
    return landing.read_series_csv(spark, _landed_csv(spark, sf_dir, "csv"), SERIES_SCHEMA, bind="position")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    landing.write_csv(table(spark, sf_dir, "customer"), path)
    types = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}
    inferred = landing.read_inferred_csv(spark, path)
    return inferred.select(*[F.col(name).cast(types.get(name, "string")).alias(name) for name in inferred.columns])


@query("""
SELECT source, n_files, n_rows, n_rows >= 10 AS passed FROM (
  SELECT 'orders' AS source, CAST(2 AS BIGINT) AS n_files,
         (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) AS n_rows
  UNION ALL SELECT 'region', 1, (SELECT count(*) FROM region)
  UNION ALL SELECT 'absent', 0, 0)
""")
def rowcount_gate(spark, sf_dir):
    raw_dir = scratch_path(spark, "gate")
    for name, source in (("orders_a", "orders"), ("orders_b", "customer"), ("region_a", "region")):
        landing.write_csv(table(spark, sf_dir, source), f"{raw_dir}/{name}.csv")
    return landing.gate_rows(landing.landed_rows(spark, raw_dir), ["orders", "region", "absent"])


# --- bronze ---


@query("""
SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, 'customer' AS _source,
       TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier', TIMESTAMP '2024-02-01 00:00:00' FROM supplier
""")
def bronze_evolution(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS acctbal")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS acctbal", "c_mktsegment AS segment"
    )
    landing.append_bronze(landing.stamp(suppliers, "supplier", "2024-02-01 00:00:00"), path)
    landing.append_bronze(landing.stamp(customers, "customer", "2024-01-01 00:00:00"), path)
    return landing.read_bronze(spark, path).withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(year(o_orderdate) AS DOUBLE) AS amount, NULL AS clerk FROM orders
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CAST(l_extendedprice AS DOUBLE), NULL FROM lineitem
UNION ALL SELECT 'c' || c_custkey, NULL, c_name FROM customer
""")
def bronze_types(spark, sf_dir):
    """Whole numbers in one load, fractions in the next, text for numbers in the last."""
    path = scratch_path(spark, "types")
    loads = [
        table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "year(o_orderdate) AS amount"),
        table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS id", "CAST(l_extendedprice AS double) AS amount"),
        table(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey) AS id", "c_name AS clerk"),
    ]
    for rows in loads:
        landing.append_bronze(rows, path)
    return landing.read_bronze(spark, path)


@query("""
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
""")
def written_row_metrics(spark, sf_dir):
    """Whole tables as they are landed, with the counts that their writes report; they must agree with what is read back."""
    path, counts = scratch_path(spark, "metrics"), []
    for name in ("orders", "lineitem"):
        observed = landing.append_bronze(landing.stamp(table(spark, sf_dir, name), name), f"{path}/{name}")
        stored = landing.read_bronze(spark, f"{path}/{name}").groupBy(F.col("_source").alias("table_name")).agg(F.count(F.lit(1)).alias("n_rows"))
        found = stored.first()["n_rows"]
        if found != observed:
            raise AssertionError(f"{observed} rows were reported and {found} written")
        counts.append(stored)
    return counts[0].unionByName(counts[1])


# --- tables ---

ORDER_TABLE = StructType(
    [
        StructField("chave", LongType()),
        StructField("fonte", StringType()),
        StructField("ano", IntegerType()),
        StructField("valor", DoubleType()),
    ]
)


def _base_and_batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders before 2000 as the table; a batch that restates urgent orders under another
    status, which moves them to another partition, and adds the later ones."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("chave"),
        F.col("o_orderstatus").alias("fonte"),
        F.year("o_orderdate").alias("ano"),
        F.col("o_totalprice").alias("valor"),
        "o_orderpriority",
    )
    base = orders.filter("ano < 2000")
    urgent = base.filter("o_orderpriority = '1-URGENT'").withColumn("fonte", F.lit("X")).withColumn("valor", F.col("valor") + 1)
    batch = urgent.unionByName(orders.filter("ano >= 2000"))
    return base.select(*ORDER_TABLE.names), batch.select(*ORDER_TABLE.names)


UPSERTED_SQL = """
  SELECT o_orderkey AS chave, CAST(year(o_orderdate) AS INTEGER) AS ano,
         CASE WHEN year(o_orderdate) < 2000 AND o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS fonte,
         CASE WHEN year(o_orderdate) < 2000 AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS valor
  FROM orders
"""


@query(UPSERTED_SQL)
def merge_by_key(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    return tables.merge_rows(base, batch, ["chave"])


@query(UPSERTED_SQL)
def observed_upsert(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    path = scratch_path(spark, "table")
    tables.write_partitioned(base, path, ["fonte", "ano"])
    tables.upsert(spark, path, batch, ["chave"], ["fonte", "ano"])
    return tables.load(spark, path, schema=ORDER_TABLE)


@query(UPSERTED_SQL)
def upsert_by_summaries(spark, sf_dir):
    """The same batch in two halves, with key summaries however small the table: the second half finds them."""
    base, batch = _base_and_batch(spark, sf_dir)
    path = scratch_path(spark, "table")
    for rows in (base, batch.filter("ano < 2000"), batch.filter("ano >= 2000")):
        tables.upsert(spark, path, rows, ["chave"], ["fonte", "ano"], small_table=0)
    return tables.load(spark, path, schema=ORDER_TABLE)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "table")
    tables.write_partitioned(table(spark, sf_dir, "customer"), path, ["c_mktsegment", "c_nationkey"])
    return tables.load(spark, path)


@query("SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY s_nationkey")
def exported_view(spark, sf_dir):
    path = scratch_path(spark, "export")
    tables.export_parquet(table(spark, sf_dir, "supplier"), path)
    tables.register_view(spark, "exported_supplier", path)
    return spark.sql("SELECT s_nationkey, count(*) AS n_suppliers FROM exported_supplier GROUP BY s_nationkey")


@query("SELECT l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY l_suppkey")
def stored_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
    tables.create_table_as(lines, "tidemark_stored_query", scratch_path(spark, "stored"))
    return spark.table("tidemark_stored_query")


# --- the whole run: payloads to marts ---

# Which orders stand for which source and candidate, moved to the years that the marts cover. Candidates before the
# one with rows are empty documents.
STAND_INS = {
    "bcb_selic": (0, "1-URGENT"),
    "bcb_ipca": (0, "2-HIGH"),
    "bcb_cambio": (0, "3-MEDIUM"),
    "ipea_desemprego": (0, "4-NOT SPECIFIED"),
    "ipea_gini": (3, "5-LOW"),
}
YEARS_LATER = 20
MONTHLY_LATER_SQL = f"""
  SELECT o_orderpriority AS p, year(o_orderdate) + {YEARS_LATER} AS ano, month(o_orderdate) AS mes,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS valor
  FROM orders GROUP BY ALL
"""
QUARTERLY_LATER_SQL = f"""
  SELECT year(l_shipdate) + {YEARS_LATER} AS ano, quarter(l_shipdate) AS q,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS valor
  FROM lineitem GROUP BY ALL
"""
WHOLE_RUN_SQL = f"""
WITH monthly AS ({MONTHLY_LATER_SQL}),
quarterly AS ({QUARTERLY_LATER_SQL}),
means AS (SELECT ano, p, round(avg(valor), 4) AS m FROM monthly GROUP BY ano, p
          UNION ALL SELECT ano, 'pib', round(avg(valor), 4) FROM quarterly GROUP BY ano),
panel AS (
  SELECT CAST(ano AS INTEGER) AS ano, max(CASE WHEN p = '1-URGENT' THEN m END) AS selic_media,
         max(CASE WHEN p = '2-HIGH' THEN m END) AS ipca_media, max(CASE WHEN p = '3-MEDIUM' THEN m END) AS cambio_medio,
         max(CASE WHEN p = 'pib' THEN m END) AS pib_variacao_media,
         max(CASE WHEN p = '4-NOT SPECIFIED' THEN m END) AS desemprego_medio, max(CASE WHEN p = '5-LOW' THEN m END) AS renda_media_pc
  FROM means WHERE ano >= 2015 GROUP BY ano),
wide AS (SELECT ano, mes, max(CASE WHEN p = '2-HIGH' THEN valor END) AS ipca, max(CASE WHEN p = '3-MEDIUM' THEN valor END) AS cambio
         FROM monthly GROUP BY ano, mes),
gaps AS (SELECT ano, round(avg(cambio - before), 2) AS cambio_vs_ipca_defasado FROM (
           SELECT *, lag(ipca) OVER (ORDER BY ano, mes) AS before FROM wide) GROUP BY ano)
SELECT panel.*, cambio_vs_ipca_defasado FROM panel LEFT JOIN gaps USING (ano)
"""


def _write_payloads(spark, sf_dir, payload_dir: str) -> None:
    """One document per source, from one aggregation of each table; earlier candidates are empty."""
    later = F.col("ano") + YEARS_LATER
    monthly = monthly_landing(table(spark, sf_dir, "orders")).select("indicador", F.make_date(later, "mes", F.lit(1)).alias("day"), "valor")
    sgs = F.to_json(F.collect_list(F.struct(F.date_format("day", "dd/MM/yyyy").alias("data"), F.col("valor").cast("string").alias("valor"))))
    items = F.collect_list(F.struct(F.col("valor").alias("VALVALOR"), F.date_format("day", "yyyy-MM-dd'T'00:00:00'-03:00'").alias("VALDATA")))
    by_priority = monthly.groupBy("indicador").agg(sgs.alias("sgs"), F.to_json(F.struct(items.alias("value"))).alias("odata"))
    by_priority = materialise(by_priority, "payloads")
    for source, (place, priority) in STAND_INS.items():
        document = by_priority.filter(F.col("indicador") == priority).select(candidates.CANDIDATES[source][place].kind)
        document.write.text(candidates.payload_path(payload_dir, source, place))
    lines = table(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.lit("all"))
    period = F.concat(later.cast("string"), F.lit("0"), F.col("trimestre").cast("string"))
    entries = F.map_from_entries(F.collect_list(F.struct(period, F.col("valor").cast("string"))))
    serie = quarterly_landing(lines).groupBy().agg(entries.alias("serie"))
    place = F.struct(F.lit("Brasil").alias("nome")).alias("localidade")
    series = F.array(F.struct(place, F.col("serie")))
    serie.select(_sidra_document(series)).write.text(candidates.payload_path(payload_dir, "ibge_pib", 1))
    empty = spark.range(1)
    empty.select(F.lit("[]")).write.text(candidates.payload_path(payload_dir, "ibge_pib", 0))
    empty.select(F.lit('{"value": []}')).write.text(candidates.payload_path(payload_dir, "ipea_gini", 1))


@query(WHOLE_RUN_SQL)
def whole_run(spark, sf_dir):
    base = scratch_path(spark, "whole-run")
    _write_payloads(spark, sf_dir, f"{base}/payloads")
    report = medallion.run(spark, f"{base}/raw", base, payload_dir=f"{base}/payloads")
    if not report.filter("status <> 'pass'").isEmpty():
        raise AssertionError("the marts fail their checks")
    panel, lagged = (tables.load(spark, f"{base}/gold/{name}") for name in ("annual_panel", "lagged_comparison"))
    return panel.join(lagged.select("ano", "cambio_vs_ipca_defasado"), "ano", "left")


@query(f"""
SELECT 'bcb_ipca' AS source, count(*) AS n_rows, sum(valor) IS NOT NULL AS has_values FROM ({MONTHLY_LATER_SQL}) WHERE p = '2-HIGH'
UNION ALL SELECT 'ibge_pib', count(*), sum(valor) IS NOT NULL FROM ({QUARTERLY_LATER_SQL})
""")
def source_subset(spark, sf_dir):
    """Only the chosen sources are landed and ingested, whatever payloads there are."""
    base, names = scratch_path(spark, "subset"), ["bcb_ipca", "ibge_pib"]
    _write_payloads(spark, sf_dir, f"{base}/payloads")
    candidates.land_sources(spark, f"{base}/payloads", f"{base}/raw", names)
    medallion.ingest_bronze(spark, f"{base}/raw", base, names)
    bronze = [landing.read_bronze(spark, f"{base}/bronze/{group}").select("_source", "valor") for group in ("series_bcb", "pib")]
    rows = bronze[0].unionByName(bronze[1]).groupBy(F.col("_source").alias("source"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), (F.count("valor") > 0).alias("has_values"))
