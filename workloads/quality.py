"""Data-quality checks on tables with known failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import checks, suite
from tidemark.operators.ledger import run_recorded_checks
from tidemark.session import scratch_path
from tidemark.sources.tables import publish, write_partitioned
from workloads.inputs import table
from workloads.registry import query

# --- single rows ---


@query("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL")
def check_not_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return checks.not_null(orders, "status")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND (NOT l_quantity > 1 OR NOT l_quantity < 50 - l_tax * 100)
""")
def check_accepted_range(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    failing = checks.accepted_range(
        lines, "l_quantity", 1, "50 - l_tax * 100", inclusive=False, where="l_shipdate >= timestamp_ntz'1998-01-01'"
    )
    return failing.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")


@query("SELECT p_partkey, p_size, p_retailprice FROM part WHERE NOT (p_size * 30 < p_retailprice)")
def check_expression_is_true(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return checks.expression_is_true(parts, "p_size * 30 < p_retailprice")


@query("SELECT p_partkey, p_size FROM part WHERE p_size > 5 AND NOT (p_size <= 40)")
def check_column_expression(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return checks.expression_is_true(parts, "<= 40", column="p_size", where="p_size > 5")


@query("SELECT trim(tag) AS tag FROM (SELECT CASE event_type WHEN 'error' THEN '  ' WHEN 'view' THEN NULL ELSE props END AS tag FROM events) WHERE trim(tag) = ''")
def check_not_empty_string(spark, sf_dir):
    tag = F.when(F.col("event_type") == "error", "  ").when(F.col("event_type") != "view", F.col("props"))
    return checks.not_empty_string(table(spark, sf_dir, "events").select(tag.alias("tag")), "tag")


@query("SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount <> l_tax")
def check_assert_equal(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return checks.assert_equal(lines, "l_discount", "l_tax")


# --- values and groups ---


@query("SELECT l_partkey AS unique_field, count(*) AS n_records FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def check_unique(spark, sf_dir):
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_partkey")


@query("SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique_combination(spark, sf_dir):
    return checks.unique_combination_of_columns(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def check_accepted_values(spark, sf_dir):
    return checks.accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'view', 'none')")
def check_not_accepted_values(spark, sf_dir):
    return checks.not_accepted_values(table(spark, sf_dir, "events"), "event_type", ["error", "view", "none"])


@query("SELECT user_id, count(large) AS filler_column FROM (SELECT user_id, CASE WHEN value > 250 THEN value END AS large FROM events) GROUP BY 1 HAVING count(large) = 0")
def check_at_least_one(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", F.when(F.col("value") > 250, F.col("value")).alias("large"))
    return checks.at_least_one(events, "large", ["user_id"])


@query("SELECT CAST(count(nothing) AS BIGINT) AS filler_column FROM (SELECT CASE WHEN o_orderkey < 0 THEN 1 END AS nothing FROM orders) HAVING count(nothing) = 0")
def check_at_least_one_whole(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") < 0, 1).alias("nothing"))
    return checks.at_least_one(orders, "nothing")


@query("SELECT l_orderkey, count(DISTINCT l_returnflag) AS filler_column FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1")
def check_not_constant(spark, sf_dir):
    return checks.not_constant(table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_orderkey"])


@query("""
SELECT o_orderpriority, share AS not_null_proportion FROM (
  SELECT o_orderpriority, count(CASE WHEN o_totalprice > 150000 THEN 1 END) / CAST(count(*) AS DOUBLE) AS share
  FROM orders GROUP BY 1) WHERE share < 0.9 OR share > 1
""")
def check_not_null_proportion(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", F.when(F.col("o_totalprice") > 150000, 1).alias("high"))
    return checks.not_null_proportion(orders, "high", at_least=0.9, group_by=["o_orderpriority"])


@query("""
SELECT c AS o_custkey, CAST(newest AS DATE) AS most_recent, CAST(TIMESTAMP '2001-07-31 12:00:00' - INTERVAL 2 MONTH AS DATE) AS threshold
FROM (SELECT o_custkey AS c, max(o_orderdate) AS newest FROM orders GROUP BY 1)
WHERE CAST(newest AS DATE) < CAST(TIMESTAMP '2001-07-31 12:00:00' - INTERVAL 2 MONTH AS DATE)
""")
def check_recency(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return checks.recency(
        orders, "o_orderdate", "month", 2, ignore_time_component=True, group_by=["o_custkey"], as_of="2001-07-31 12:00:00"
    )


@query("""
SELECT event_type, max(ts) AS most_recent, TIMESTAMP '2030-01-01 00:00:00' - INTERVAL 6 HOUR AS threshold
FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2030-01-01 00:00:00' - INTERVAL 6 HOUR
""")
def check_recency_with_time(spark, sf_dir):
    return checks.recency(table(spark, sf_dir, "events"), "ts", "hour", 6, group_by=["event_type"], as_of="2030-01-01 00:00:00")


# --- row order ---

SEQUENCE_SQL = """
SELECT {keys} {column}, previous AS previous_{column} FROM (
  SELECT {keys} {column}, lag({column}) OVER ({partition} ORDER BY {column} NULLS LAST) AS previous FROM {source})
WHERE NOT ({column} = {following})
"""
LINES_BY_ORDER = SEQUENCE_SQL.format(
    keys="l_orderkey,", column="l_linenumber", partition="PARTITION BY l_orderkey", source="lineitem", following="previous + 1"
)
KEYS_OF_ORDERS = SEQUENCE_SQL.format(keys="", column="l_orderkey", partition="", source="lineitem", following="previous + 1")


@query(LINES_BY_ORDER)
def check_sequential_values(spark, sf_dir):
    return checks.sequential_values(table(spark, sf_dir, "lineitem"), "l_linenumber", group_by=["l_orderkey"])


# One group for each flag holds a third of all rows, and most rows are ties; every seventh number is missing.
@query(SEQUENCE_SQL.format(
    keys="l_returnflag,",
    column="number",
    partition="PARTITION BY l_returnflag",
    source="(SELECT l_returnflag, CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey % 500 END AS number FROM lineitem)",
    following="previous + 1",
))
def check_sequential_values_chunked(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    numbered = lines.select("l_returnflag", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey") % 500).alias("number"))
    return checks.sequential_values(numbered, "number", group_by=["l_returnflag"])


@query(KEYS_OF_ORDERS)
def check_sequence_of_whole_table(spark, sf_dir):
    return checks.sequential_values(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(SEQUENCE_SQL.format(
    keys="o_custkey,",
    column="o_orderdate",
    partition="PARTITION BY o_custkey",
    source="orders",
    following="previous + INTERVAL 1 DAY",
))
def check_sequential_dates(spark, sf_dir):
    return checks.sequential_values(table(spark, sf_dir, "orders"), "o_orderdate", 1, "day", ["o_custkey"])


# Every range is placed in its group once; the next one is the range at the following place, the last one the highest.
RANGES_SQL = """
WITH ranges AS (
  SELECT o_orderkey AS id, {group} AS partition_by_col, {lower} AS lower_bound, {upper} AS upper_bound
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS later FROM orders)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY partition_by_col ORDER BY lower_bound NULLS LAST, upper_bound NULLS LAST, id) AS place,
         row_number() OVER (PARTITION BY partition_by_col ORDER BY lower_bound NULLS FIRST, upper_bound NULLS FIRST, id) AS height
  FROM ranges),
highest AS (SELECT partition_by_col, max(height) AS top FROM placed GROUP BY partition_by_col)
SELECT {shown} FROM (
  SELECT p.partition_by_col, p.lower_bound, p.upper_bound, n.lower_bound AS next_lower_bound, p.height = h.top AS is_last_record,
         coalesce(p.lower_bound {length} p.upper_bound, false) AS {length_name},
         coalesce(p.upper_bound {gap} n.lower_bound, p.height = h.top, false) AS {gap_name}
  FROM placed p JOIN highest h USING (partition_by_col)
  LEFT JOIN placed n ON n.partition_by_col = p.partition_by_col AND n.place = p.place + 1)
WHERE NOT ({length_name} AND {gap_name})
"""
ALLOWED = {
    "length": "<",
    "length_name": "lower_bound_less_than_upper_bound",
    "gap": "<=",
    "gap_name": "upper_bound_less_than_or_equal_to_next_lower_bound",
}
RANGES = RANGES_SQL.format(group="o_custkey", lower="day", upper="later", shown="*", **ALLOWED)
RANGES_WITH_NULLS = RANGES_SQL.format(
    group="o_orderpriority",
    lower="CASE WHEN o_orderkey % 17 <> 0 THEN date_trunc('month', day)::DATE END",
    upper="CASE WHEN o_orderkey % 5 <> 0 THEN date_trunc('month', later)::DATE END",
    shown="*",
    **ALLOWED,
)
RANGES_WHOLE = RANGES_SQL.format(
    group="0",
    lower="day",
    upper="later",
    shown="* EXCLUDE (partition_by_col)",
    length="<=",
    length_name="lower_bound_less_than_or_equal_to_upper_bound",
    gap="=",
    gap_name="upper_bound_equal_to_next_lower_bound",
)


def _ranges(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.to_date("o_orderdate").alias("valid_from"),
        F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int")).alias("valid_to"),
    )


@query(RANGES)
def check_ranges(spark, sf_dir):
    return checks.mutually_exclusive_ranges(_ranges(spark, sf_dir), "valid_from", "valid_to", "o_custkey")


@query(RANGES_WITH_NULLS)
def check_ranges_chunked(spark, sf_dir):
    """A few large groups, with ties and bounds that are missing."""
    month = lambda day: F.trunc(day, "month")
    lower = F.when(F.col("o_orderkey") % 17 != 0, month(F.to_date("o_orderdate")))
    later = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int"))
    upper = F.when(F.col("o_orderkey") % 5 != 0, month(later))
    ranges = table(spark, sf_dir, "orders").select("o_orderpriority", lower.alias("valid_from"), upper.alias("valid_to"))
    return checks.mutually_exclusive_ranges(ranges, "valid_from", "valid_to", "o_orderpriority")


@query(RANGES_WHOLE)
def check_ranges_of_whole_table(spark, sf_dir):
    ranges = _ranges(spark, sf_dir)
    return checks.mutually_exclusive_ranges(ranges, "valid_from", "valid_to", gaps="not_allowed", zero_length_range_allowed=True)


# --- against another table ---


@query("""
SELECT l.o_custkey AS id, CAST(NULL AS BIGINT) AS right_id
FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus <> 'P') l
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') r ON l.o_custkey = r.c_custkey
WHERE r.c_custkey IS NULL
""")
def check_relationships_where(spark, sf_dir):
    return checks.relationships_where(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        table(spark, sf_dir, "customer"),
        "c_custkey",
        "o_orderstatus <> 'P'",
        "c_mktsegment <> 'BUILDING'",
    )


@query("""
WITH a AS (SELECT c_nationkey, count(*) AS num_rows FROM customer GROUP BY 1),
b AS (SELECT s_nationkey, count(*) AS num_rows FROM supplier GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def check_cardinality_equality(spark, sf_dir):
    return checks.cardinality_equality(
        table(spark, sf_dir, "customer"), "c_nationkey", table(spark, sf_dir, "supplier"), "s_nationkey"
    )


GROUP_COUNTS_SQL = """
  WITH a AS (SELECT o_custkey AS k, count(*) AS na FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
  b AS (SELECT o_custkey AS k, count(*) AS nb FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' GROUP BY 1),
  counts AS (SELECT coalesce(a.k, b.k) AS o_custkey, coalesce(na, 0) AS na, coalesce(nb, 0) AS nb,
             a.k IS NOT NULL AND b.k IS NOT NULL AS both_sides FROM a FULL JOIN b ON a.k = b.k)
"""


def _settled_and_others(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    settled = F.col("o_orderstatus").eqNullSafe("F")
    return orders.filter(settled), orders.filter(~settled)


@query(f"{GROUP_COUNTS_SQL} SELECT o_custkey, na AS count_a, nb AS count_b, abs(na - nb) AS diff_count FROM counts WHERE na <> nb")
def check_equal_rowcount(spark, sf_dir):
    return checks.equal_rowcount(*_settled_and_others(spark, sf_dir), ["o_custkey"])


@query(f"{GROUP_COUNTS_SQL} SELECT o_custkey, na AS count_a, nb AS count_b, abs(na - nb) AS diff_count FROM counts WHERE na <> nb AND both_sides")
def check_equal_rowcount_shared(spark, sf_dir):
    return checks.equal_rowcount(*_settled_and_others(spark, sf_dir), ["o_custkey"], strict=False)


@query(f"""{GROUP_COUNTS_SQL}
SELECT o_custkey, na AS count_our_model, nb AS count_comparison_model, CASE WHEN na > nb THEN na - nb ELSE 1 END AS row_count_delta
FROM counts WHERE na >= nb""")
def check_fewer_rows_than(spark, sf_dir):
    return checks.fewer_rows_than(*_settled_and_others(spark, sf_dir), ["o_custkey"])


@query("""
WITH a AS (SELECT count(*) AS na FROM lineitem), b AS (SELECT count(*) AS nb FROM orders)
SELECT na AS count_our_model, nb AS count_comparison_model, na - nb AS row_count_delta FROM a, b WHERE na > nb
""")
def check_fewer_rows_whole(spark, sf_dir):
    return checks.fewer_rows_than(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


EQUALITY_SQL = """
WITH a AS (SELECT l_partkey, CAST(l_discount AS DOUBLE) AS d FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT l_partkey, CAST(l_discount + 0.0001 AS DOUBLE) AS d FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'A'),
ra AS (SELECT l_partkey, round(d, 2) AS d FROM a), rb AS (SELECT l_partkey, round(d, 2) AS d FROM b)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM ra EXCEPT{all} SELECT * FROM rb)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM rb EXCEPT{all} SELECT * FROM ra)
"""


def _discounts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag").eqNullSafe("A")
    a = lines.filter(returned).select("l_partkey", F.col("l_discount").alias("d"), "l_tax")
    b = lines.filter(~returned).select("l_partkey", (F.col("l_discount") + 0.0001).alias("d"), "l_quantity")
    return a, b


@query(EQUALITY_SQL.format(all=""))
def check_equality(spark, sf_dir):
    return checks.equality(*_discounts(spark, sf_dir), compare_columns=["l_partkey", "d"], precision=2)


@query(EQUALITY_SQL.format(all=" ALL"))
def check_equality_multiset(spark, sf_dir):
    a, b = _discounts(spark, sf_dir)
    return checks.equality(a.drop("l_tax"), b, exclude_columns=["L_QUANTITY"], precision=2, multiset=True)


@query("""
WITH changed AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 1009 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderkey % 2003 <> 11),
given AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)
SELECT 'a_minus_b' AS which_diff, * FROM (FROM given EXCEPT ALL FROM changed)
UNION ALL SELECT 'b_minus_a', * FROM (FROM changed EXCEPT ALL FROM given)
""")
def check_equality_by_digests(spark, sf_dir):
    """Two copies of a table, one of them with a few rows changed and a few missing."""
    given = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 1009 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    changed = given.filter("o_orderkey % 2003 <> 11").withColumn("o_totalprice", price)
    return checks.equality(given, changed, multiset=True, digests=True)


@query("""
WITH expected AS (SELECT unnest(['p_partkey', 'p_name', 'p_brand', 'p_colour']) AS name),
actual AS (SELECT column_name AS name FROM (DESCRIBE part))
SELECT e.name AS expected_column, a.name AS actual_column FROM expected e FULL JOIN actual a ON e.name = a.name
WHERE e.name IS NULL OR a.name IS NULL
""")
def check_columns_match_set(spark, sf_dir):
    return checks.columns_match_set(table(spark, sf_dir, "part"), ["p_partkey", "P_NAME", "p_brand", "p_colour"])


# --- reports ---


@query("""
SELECT check_name, failures, CASE check_name
  WHEN 'status_accepted' THEN CASE WHEN failures <> 0 THEN 'warn' ELSE 'pass' END
  WHEN 'part_unique' THEN CASE WHEN failures > 1000000000 THEN 'fail' WHEN failures <> 0 THEN 'warn' ELSE 'pass' END
  ELSE CASE WHEN failures <> 0 THEN 'fail' ELSE 'pass' END END AS status
FROM (
  SELECT 'customer_not_null' AS check_name, (SELECT count(*) FROM orders WHERE o_custkey IS NULL) AS failures
  UNION ALL SELECT 'status_accepted', (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('O', 'F'))
  UNION ALL SELECT 'part_unique', (SELECT count(*) FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'rows_equal', (SELECT abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM customer)))
  UNION ALL SELECT 'nations_equal', (
    WITH a AS (SELECT c_nationkey AS n FROM customer WHERE c_acctbal > 5000), b AS (SELECT s_nationkey AS n FROM supplier),
    ab AS (SELECT n FROM a EXCEPT SELECT n FROM b), ba AS (SELECT n FROM b EXCEPT SELECT n FROM a)
    SELECT (SELECT count(*) FROM ab) + (SELECT count(*) FROM ba) + abs((SELECT count(*) FROM ab) - (SELECT count(*) FROM ba))))
""")
def check_suite(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rich = customers.filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("n"))
    nations = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n"))
    return suite.run_suite(
        [
            suite.Check("customer_not_null", checks.not_null(orders, "o_custkey")),
            suite.Check(
                "status_accepted",
                checks.accepted_values(orders, "o_orderstatus", ["O", "F"]),
                thresholds=suite.Thresholds(severity="warn"),
            ),
            suite.Check(
                "part_unique",
                checks.unique(table(spark, sf_dir, "lineitem"), "l_partkey"),
                thresholds=suite.Thresholds(error_if="> 1000000000"),
            ),
            suite.Check("rows_equal", checks.equal_rowcount(orders, customers), suite.sum_weight("diff_count")),
            suite.Check("nations_equal", checks.equality(rich, nations), suite.surplus_weight()),
        ]
    )


@query("""
SELECT check_name, failures, CASE WHEN failures <> 0 THEN 'fail' ELSE 'pass' END AS status FROM (
  SELECT 'quantity_range' AS check_name, (SELECT count(*) FROM lineitem WHERE l_quantity < 2 OR l_quantity > 49) AS failures
  UNION ALL SELECT 'flag_present', (SELECT count(*) FROM lineitem WHERE l_returnflag IS NULL)
  UNION ALL SELECT 'tax_below_discount', (SELECT count(*) FROM lineitem WHERE l_linenumber > 3 AND NOT l_tax < l_discount)
  UNION ALL SELECT 'flag_filled', (SELECT count(*) FROM lineitem WHERE trim(l_returnflag) = ''))
""")
def check_rows_in_one_scan(spark, sf_dir):
    return suite.run_row_checks(
        table(spark, sf_dir, "lineitem"),
        [
            suite.RowCheck("quantity_range", checks.is_out_of_range("l_quantity", 2, 49)),
            suite.RowCheck("flag_present", checks.is_missing("l_returnflag")),
            suite.RowCheck("tax_below_discount", checks.is_untrue("l_tax < l_discount"), where="l_linenumber > 3"),
            suite.RowCheck("flag_filled", checks.is_blank("l_returnflag")),
        ],
    )


@query("""
SELECT check_name, failures, CASE WHEN failures <> 0 THEN 'fail' ELSE 'pass' END AS status FROM (
  SELECT 'price_in_range' AS check_name, (SELECT count(*) FROM orders WHERE NOT (o_totalprice <= 250000) AND o_orderstatus <> 'P') AS failures
  UNION ALL SELECT 'customer_not_null', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 3 = 0)
  UNION ALL SELECT 'key_not_null', 0)
""")
def check_ledger(spark, sf_dir):
    """A report on whole orders, and one after a partition has been written anew: the second scans that partition only."""
    path, record = scratch_path(spark, "ledger-table"), scratch_path(spark, "ledger")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    row_checks = [
        suite.RowCheck("price_in_range", checks.is_out_of_range("o_totalprice", max_value=250000)),
        suite.RowCheck("customer_not_null", checks.is_missing("o_custkey")),
        suite.RowCheck("key_not_null", checks.is_missing("o_orderkey")),
    ]
    write_partitioned(orders, path, ["o_orderstatus"])
    run_recorded_checks(spark, path, record, row_checks, orders.schema)
    customer = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey")
    partly = orders.filter("o_orderstatus = 'P'").select("o_orderkey", customer, F.lit(0.0).alias("o_totalprice"), "o_orderstatus")
    publish(partly, path, ["o_orderstatus"])
    return run_recorded_checks(spark, path, record, row_checks, orders.schema)
