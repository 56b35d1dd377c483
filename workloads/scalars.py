"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import tidemark.functions as fn
from workloads.inputs import table
from workloads.registry import query


@query("""
SELECT l_orderkey, l_linenumber,
       coalesce(nullif(l_quantity, 10), 0) + coalesce(l_tax, 0) + 1 AS added,
       coalesce(nullif(l_quantity, 10), 0) - coalesce(l_tax, 0) - 1 AS subtracted,
       l_extendedprice / nullif(l_discount, 0) AS divided,
       (l_quantity - 1) / nullif(l_quantity - 10, 0) AS divided_expressions
FROM lineitem
""")
def safe_math(spark, sf_dir):
    quantity = F.nullif(F.col("l_quantity"), F.lit(10))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.safe_add([quantity, "l_tax", 1]).alias("added"),
        fn.safe_subtract([quantity, "l_tax", 1]).alias("subtracted"),
        fn.safe_divide("l_extendedprice", "l_discount").alias("divided"),
        fn.safe_divide(F.col("l_quantity") - 1, F.col("l_quantity") - 10).alias("divided_expressions"),
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_quantity < 8 THEN 0 WHEN l_quantity >= 40 THEN 6
            ELSE floor((l_quantity - 8) / 32 * 5) + 1 END AS BIGINT) AS bucket
FROM lineitem
""")
def width_bucket(spark, sf_dir):
    bucket = fn.width_bucket("l_quantity", 8.0, 40.0, 5)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", bucket.alias("bucket"))


@query("""
WITH places AS (SELECT c_custkey, c_nationkey * 3.0 - 36 AS lat1, c_nationkey * 7.0 - 84 AS lon1,
                       c_acctbal / 200 AS lat2, c_acctbal / 100 AS lon2 FROM customer),
arcs AS (SELECT c_custkey, 2 * 3961 * asin(sqrt(
    power(sin(radians((lat2 - lat1) / 2)), 2) +
    cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2))) AS miles FROM places)
SELECT c_custkey, CAST(round(miles, 3) AS DECIMAL(12,3)) AS miles, CAST(round(miles * 1.60934, 3) AS DECIMAL(12,3)) AS km FROM arcs
""")
def haversine(spark, sf_dir):
    places = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_nationkey * 3.0D - 36 AS lat1",
        "c_nationkey * 7.0D - 84 AS lon1",
        "c_acctbal / 200 AS lat2",
        "c_acctbal / 100 AS lon2",
    )
    ends = ("lat1", "lon1", "lat2", "lon2")
    return places.select(
        "c_custkey",
        *[F.round(fn.haversine(*ends, unit), 3).cast("decimal(12,3)").alias(name) for unit, name in (("mi", "miles"), ("km", "km"))],
    )


@query("""
SELECT p_partkey,
       md5(coalesce(CAST(p_partkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(nullif(p_brand, 'Brand#1'), '_dbt_utils_surrogate_key_null_')) AS key_marked,
       md5(CAST(p_partkey AS VARCHAR) || '-' || coalesce(nullif(p_brand, 'Brand#1'), '')) AS key_blank,
       md5(p_name) AS key_single
FROM part
""")
def surrogate_key(spark, sf_dir):
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#1"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        fn.surrogate_key(["p_partkey", brand]).alias("key_marked"),
        fn.surrogate_key(["p_partkey", brand], nulls_as_empty=True).alias("key_blank"),
        fn.surrogate_key(["p_name"]).alias("key_single"),
    )


@query("""
WITH words AS (SELECT o_orderkey, regexp_replace(lower(o_orderpriority), '[ -]+', '_', 'g') AS word FROM orders)
SELECT o_orderkey, regexp_replace(regexp_replace(word, '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug FROM words
""")
def slugify(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.slugify("o_orderpriority").alias("slug"))


@query("SELECT DISTINCT o_orderpriority || '_' || o_orderstatus AS composite, o_orderstatus AS partial FROM orders")
def composite_key(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select(
            fn.composite_key("o_orderpriority", "o_orderstatus").alias("composite"),
            fn.composite_key(F.lit(None).cast("string"), "o_orderstatus").alias("partial"),
        )
        .distinct()
    )


@query("""
SELECT page_id, split_part(split_part(
         replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host
FROM pages
""")
def url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fn.url_host("url").alias("host"))


@query("""
WITH bare AS (SELECT page_id, replace(replace(url, 'http://', ''), 'https://', '') AS u FROM pages),
placed AS (SELECT page_id, u, coalesce(nullif(strpos(u, '/'), 0), strpos(u, '?') - 1) AS p FROM bare)
SELECT page_id, split_part(substr(u, greatest(p + 1, 1)), '?', 1) AS path FROM placed
""")
def url_path(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fn.url_path("url").alias("path"))


@query("""
SELECT page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
       nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
       nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source
FROM pages
""")
def url_param(spark, sf_dir):
    names = ("page", "ref", "utm_source")
    return table(spark, sf_dir, "pages").select("page_id", *[fn.url_parameter("url", name).alias(name) for name in names])


@query("""
SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_number, TRY_CAST(p_brand AS INTEGER) AS no_number,
       nullif(CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END, '') AS type_or_null,
       trim('  ' || p_name || ' ') AS trimmed, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS large,
       least(p_size, 25) AS capped, CAST(ceil(p_retailprice / 7) AS BIGINT) AS ceiling, p_size % nullif(p_size - 10, 0) AS remainder,
       power(p_size, 2) AS squared, abs(p_size - 25) AS distance
FROM part
""")
def text_and_casts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        fn.safe_cast(F.split_part("p_brand", F.lit("#"), F.lit(2)), "int").alias("brand_number"),
        fn.safe_cast("p_brand", "int").alias("no_number"),
        fn.blank_to_null(F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.col("p_type"))).alias("type_or_null"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        fn.bool_to_text(F.col("p_size") > 25).alias("large"),
        F.least("p_size", F.lit(25)).alias("capped"),
        F.ceil(F.col("p_retailprice") / 7).alias("ceiling"),
        F.try_mod("p_size", F.col("p_size") - 10).alias("remainder"),
        F.pow("p_size", F.lit(2)).alias("squared"),
        F.abs(F.col("p_size") - 25).alias("distance"),
    )


@query("""
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
       l_shipdate + INTERVAL 2 MONTH AS later, l_shipdate - INTERVAL 36 HOUR AS earlier,
       date_diff('month', l_shipdate, TIMESTAMP '2002-01-15') AS months, date_diff('day', l_shipdate, TIMESTAMP '2002-01-15') AS days,
       date_diff('quarter', l_shipdate, TIMESTAMP '2002-01-15') AS quarters,
       date_diff('hour', l_shipdate, TIMESTAMP '2002-01-15') AS hours
FROM lineitem
""")
def date_parts(spark, sf_dir):
    end = F.lit("2002-01-15").cast("timestamp_ntz")
    counts = {"months": "month", "days": "day", "quarters": "quarter", "hours": "hour"}
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.year("l_shipdate").alias("ano"),
        F.month("l_shipdate").alias("mes"),
        fn.month_start(F.year("l_shipdate"), F.month("l_shipdate")).alias("month_start"),
        fn.shift("month", 2, "l_shipdate").alias("later"),
        fn.shift("hour", -36, "l_shipdate").alias("earlier"),
        *[fn.boundary_count("l_shipdate", end, unit).alias(name) for name, unit in counts.items()],
    )


@query("""
SELECT c_custkey, coalesce('R$ ' || printf('%.2f', nullif(c_acctbal, c_custkey)) || ' m', '–') AS shown,
       CASE WHEN c_nationkey = 3 THEN '–' ELSE printf('%.1f', CAST(c_nationkey AS DOUBLE)) END AS nation
FROM customer
""")
def kpi_format(spark, sf_dir):
    nation = F.when(F.col("c_nationkey") == 3, float("nan")).otherwise(F.col("c_nationkey").cast("double"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        fn.format_kpi(F.nullif("c_acctbal", F.col("c_custkey").cast("double")), 2, "R$ ", " m").alias("shown"),
        fn.format_kpi(nation, 1).alias("nation"),
    )
