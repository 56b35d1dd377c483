"""Reshaping, unions, generators and small reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import boundary_count
from tidemark.operators import dedupe, generate, introspect, reshape, unions
from workloads.inputs import table
from workloads.registry import query

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# --- pivot and unpivot ---


@query(f"""
SELECT o_orderstatus, {", ".join(f"sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS n_{p[0]}" for p in PRIORITIES)}
FROM orders GROUP BY o_orderstatus
""")
def pivot_counts(spark, sf_dir):
    pivoted = reshape.pivot(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderpriority", PRIORITIES)
    return pivoted.withColumnsRenamed({p: f"n_{p[0]}" for p in PRIORITIES})


@query("""
SELECT l_returnflag,
       max(CASE WHEN l_linestatus <> 'F' THEN l_quantity ELSE 0 END) AS not_f_qty,
       max(CASE WHEN l_linestatus <> 'O' THEN l_quantity ELSE 0 END) AS not_o_qty
FROM lineitem GROUP BY l_returnflag
""")
def pivot_compare(spark, sf_dir):
    return reshape.pivot(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag"],
        "l_linestatus",
        ["F", "O"],
        then_value="l_quantity",
        agg="max",
        cmp="<>",
        prefix="Not ",
        suffix=" qty",
        quote_identifiers=False,
    )


@query(f"""
SELECT user_id, {", ".join(f"count(DISTINCT CASE WHEN event_type = '{t}' THEN CAST(ts AS DATE) END) AS days_{t}" for t in EVENT_TYPES)}
FROM events GROUP BY user_id
""")
def pivot_distinct(spark, sf_dir):
    return reshape.pivot(
        table(spark, sf_dir, "events"),
        ["user_id"],
        "event_type",
        EVENT_TYPES,
        agg="count",
        then_value="to_date(ts)",
        else_value="null",
        prefix="days_",
        distinct=True,
    )


@query(f"""
SELECT o_custkey, {", ".join(f"max(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END) AS top_{p[0]}" for p in PRIORITIES)}
FROM orders GROUP BY o_custkey
""")
def pivot_fixed(spark, sf_dir):
    names = {p: f"top_{p[0]}" for p in PRIORITIES}
    return reshape.pivot_fixed(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_totalprice", names)


@query("""
SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, CAST(l_quantity AS DOUBLE) AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem
""")
def unpivot_measures(spark, sf_dir):
    return reshape.unpivot(
        table(spark, sf_dir, "lineitem"),
        cast_to="double",
        exclude=["l_orderkey", "l_linenumber"],
        remove=["L_PARTKEY", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"],
        field_name="measure",
        value_name="amount",
    )


@query("""
SELECT p_partkey, 'p_brand' AS field_name, p_brand AS value FROM part
UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'is_large', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END FROM part
""")
def unpivot_text(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("is_large", F.col("p_size") > 25)
    return reshape.unpivot(parts, exclude=["p_partkey"], remove=["p_name", "p_type", "p_retailprice"])


# --- unions ---


def _people(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS ID", "s_name AS name", "s_acctbal AS balance")
    return {"customer": customers, "supplier": suppliers}


PEOPLE_SQL = """
  SELECT 'customer' AS source_relation, c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
         CAST(NULL AS DOUBLE) AS balance FROM customer
  UNION ALL
  SELECT 'supplier', s_suppkey, s_name, NULL, NULL, s_acctbal FROM supplier
"""


@query(PEOPLE_SQL)
def union_unlike(spark, sf_dir):
    return unions.union_relations(_people(spark, sf_dir))


@query(f"SELECT id, CAST(nation AS VARCHAR) AS nation FROM ({PEOPLE_SQL})")
def union_include(spark, sf_dir):
    return unions.union_relations(
        _people(spark, sf_dir), include=["id", "NATION"], column_override={"nation": "string"}, source_column_name=None
    )


@query(f"SELECT source_relation AS origin, id, name FROM ({PEOPLE_SQL})")
def union_exclude(spark, sf_dir):
    return unions.union_relations(
        _people(spark, sf_dir), exclude=["nation", "segment", "balance"], source_column_name="origin"
    )


@query(f"SELECT * FROM ({PEOPLE_SQL}) WHERE id < 50 OR name LIKE '%7'")
def union_where(spark, sf_dir):
    return unions.union_relations(_people(spark, sf_dir), where="id < 50 OR name LIKE '%7'")


@query("""
SELECT 'tidemark_party_customer' AS source_relation, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY ALL
UNION ALL SELECT 'tidemark_party_supplier', s_nationkey, count(*) FROM supplier GROUP BY ALL
""")
def union_by_prefix(spark, sf_dir):
    table(spark, sf_dir, "customer").selectExpr("c_nationkey AS nation").createOrReplaceTempView("tidemark_party_customer")
    table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation").createOrReplaceTempView("tidemark_party_supplier")
    table(spark, sf_dir, "nation").createOrReplaceTempView("tidemark_party_nation_old")
    names = unions.relations_by_prefix(spark, "default", "TideMark_party_", exclude="%_old")
    return unions.union_tables(spark, names).groupBy("source_relation", "nation").agg(F.count(F.lit(1)).alias("n"))


# --- columns ---


@query("SELECT p_partkey AS src_p_partkey_raw, p_brand AS src_p_brand_raw, p_size AS src_p_size_raw FROM part")
def star_prefix(spark, sf_dir):
    return reshape.star(table(spark, sf_dir, "part"), ["P_NAME", "p_type", "p_retailprice"], "src_", "_raw")


@query("SELECT p_type, p_size, max(p_retailprice) AS top_price FROM part GROUP BY p_type, p_size")
def star_aggregate(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    kept = reshape.star_columns(parts, ["p_partkey", "p_name", "p_brand", "p_retailprice"])
    return parts.groupBy(*kept).agg(F.max("p_retailprice").alias("top_price"))


@query("""
SELECT event_id, user_id, nullif(event_type, '') AS event_type, value, nullif(tag, '') AS tag FROM (
  SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type, value,
         CASE WHEN value < 10 THEN '' ELSE props END AS tag FROM events)
""")
def nullcheck(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type",
        "value",
        "CASE WHEN value < 10 THEN '' ELSE props END AS tag",
    )
    return reshape.nullcheck_table(events)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_quantity) AS top FROM lineitem GROUP BY 1, 2")
def group_by_n(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return reshape.group_by_first(lines, 2).agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("top"))


# --- one row per key ---


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
WHERE place = 1
""")
def dedupe_latest(spark, sf_dir):
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return dedupe.deduplicate(table(spark, sf_dir, "events"), ["user_id"], order)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_partkey DESC, l_linenumber DESC) AS place FROM lineitem)
WHERE place = 1
""")
def latest_line_per_order(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    return dedupe.latest_per_key(lines, ["l_orderkey"], ["l_shipdate"])


# --- generators, sized by the tables ---


def _day_range(spark, sf_dir, name, column):
    first, last = table(spark, sf_dir, name).agg(F.min(column), F.max(column)).first()
    return first, last


@query("SELECT CAST(unnest(range(1, (SELECT count(*) FROM orders) + 1)) AS BIGINT) AS generated_number")
def generate_series(spark, sf_dir):
    return generate.series(spark, table(spark, sf_dir, "orders").count())


@query("""
SELECT CAST(unnest(range(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date_day
FROM orders
""")
def date_spine_day(spark, sf_dir):
    first, last = _day_range(spark, sf_dir, "orders", "o_orderdate")
    return generate.date_spine(spark, "day", first.date(), last.date())


@query("""
WITH ends AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
steps AS (SELECT a, b, unnest(range(0, date_diff('month', a, b))) AS k FROM ends)
SELECT CAST(a + to_months(CAST(k AS INTEGER)) AS DATE) AS date_month FROM steps
WHERE a + to_months(CAST(k AS INTEGER)) <= b
""")
def date_spine_month(spark, sf_dir):
    first, last = _day_range(spark, sf_dir, "orders", "o_orderdate")
    return generate.date_spine(spark, "month", first.date(), last.date())


@query("""
WITH ends AS (SELECT min(ts) AS a, max(ts) AS b FROM events),
steps AS (SELECT a, b, unnest(range(0, date_diff('hour', a, b))) AS k FROM ends)
SELECT a + to_hours(k) AS date_hour FROM steps WHERE a + to_hours(k) <= b
""")
def date_spine_hour(spark, sf_dir):
    first, last = _day_range(spark, sf_dir, "events", "ts")
    return generate.date_spine(spark, "hour", first, last)


@query("""
WITH ends AS (SELECT date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events),
spine AS (SELECT unnest(range(a, b, INTERVAL 1 HOUR)) AS date_hour FROM ends),
counted AS (SELECT date_trunc('hour', ts) AS date_hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT s.date_hour, coalesce(n, 0) AS n_errors FROM spine s LEFT JOIN counted USING (date_hour)
""")
def spine_gapfill(spark, sf_dir):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min(hour), F.max(hour)).first()
    errors = events.filter("event_type = 'error'").groupBy(hour.alias("date_hour")).agg(F.count(F.lit(1)).alias("n"))
    spine = generate.date_spine(spark, "hour", first, last)
    return spine.join(errors, "date_hour", "left").select("date_hour", F.coalesce("n", F.lit(0)).alias("n_errors"))


@query("""
SELECT u AS unit, date_diff(u, min(o_orderdate), max(o_orderdate)) AS n_intervals
FROM orders, (SELECT unnest(['year', 'quarter', 'month', 'day', 'hour']) AS u) GROUP BY u
""")
def intervals_between(spark, sf_dir):
    days = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    units = ("year", "quarter", "month", "day", "hour")
    count = {u: boundary_count(F.col("first"), F.col("last"), u).cast("bigint").alias("n_intervals") for u in units}
    counts = [F.struct(F.lit(u).alias("unit"), count[u]) for u in units]
    return days.select(F.inline(F.array(*counts)))


# --- small reads ---


@query("""
SELECT o_clerk_bucket AS value, count(*) AS n_rows FROM (
  SELECT o_custkey AS o_clerk_bucket FROM orders WHERE o_orderstatus = 'O')
GROUP BY 1 ORDER BY count(*) DESC, value LIMIT 20
""")
def column_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return introspect.value_frequencies(orders, "o_custkey", max_records=20, where="o_orderstatus = 'O'")


@query("SELECT o_orderpriority AS value, row_number() OVER (ORDER BY count(*) FILTER (WHERE o_totalprice > 100), max(o_totalprice) DESC, o_orderpriority) AS place FROM orders GROUP BY 1")
def column_values_by_aggregate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    values = introspect.value_frequencies(orders, "o_orderpriority", order_by=["count_if(o_totalprice > 100) asc", "max(o_totalprice) desc"], place="place")
    return values.select("value", "place")


@query("SELECT l_orderkey AS value, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, value LIMIT 50")
def column_values_heavy(spark, sf_dir):
    """The orders with the most lines, among very many orders."""
    return introspect.most_frequent(table(spark, sf_dir, "lineitem"), "l_orderkey", 50)


@query("SELECT l_partkey AS value, count(*) AS n_rows, row_number() OVER (ORDER BY count(*) DESC, l_partkey) AS place FROM lineitem GROUP BY 1")
def column_values_numbered(spark, sf_dir):
    """All parts by how often they are ordered, numbered range by range."""
    return introspect.value_frequencies(table(spark, sf_dir, "lineitem"), "l_partkey", place="place")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= (SELECT max(o_totalprice) FROM orders)")
def empty_with_schema(spark, sf_dir):
    """The rows of the largest price, united with the empty table of the same columns."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    top = orders.agg(F.max("o_totalprice").alias("top"))
    largest = orders.filter(F.col("o_totalprice") >= top.scalar())
    return introspect.empty_like(orders).unionByName(largest)


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= (SELECT max(l_quantity) FROM lineitem)")
def single_value(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    top = introspect.single_value(lines.agg(F.max("l_quantity")))
    return lines.filter(F.col("l_quantity") >= top)


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1 HAVING avg(o_totalprice) > 0 AND min(o_totalprice) <
  (SELECT avg(low) FROM (SELECT min(o_totalprice) AS low FROM orders GROUP BY o_orderpriority)))
""")
def results_as_dict(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lows = introspect.as_dict(orders.groupBy("o_orderpriority").agg(F.min("o_totalprice").alias("low")))
    mean = sum(lows["low"]) / len(lows["low"])
    chosen = [name for name, low in zip(lows["o_orderpriority"], lows["low"]) if low < mean]
    return orders.filter(F.col("o_orderpriority").isin(chosen)).select("o_orderkey", "o_totalprice")


@query("SELECT * FROM orders ORDER BY o_totalprice DESC LIMIT 1")
def latest_row(spark, sf_dir):
    return introspect.latest(table(spark, sf_dir, "orders"), "o_totalprice")
