from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedupe, introspect, reshape, unions


@pytest.fixture
def sizes(table):
    return table("size string, color string, amount int", ("S", "red", 1), ("S", "blue", 2), ("S", "blue's", 3), ("M", "red", 4), ("S", "red", 1))


def test_pivot_counts_values(sizes, rows):
    pivoted = reshape.pivot(sizes, ["size"], "color", ["red", "blue", "blue's"])
    assert pivoted.columns == ["size", "red", "blue", "blue's"]
    assert rows(pivoted) == [("M", 1, 0, 0), ("S", 2, 1, 1)]


def test_pivot_options(sizes, rows):
    pivoted = reshape.pivot(
        sizes, ["size"], "color", ["red"], agg="max", cmp="!=", prefix="Not ", suffix="!", then_value="amount", else_value="null", quote_identifiers=False
    )
    assert pivoted.columns == ["size", "not_red"]
    assert rows(pivoted) == [("M", None), ("S", 3)]


def test_pivot_distinct(sizes, rows):
    pivoted = reshape.pivot(sizes, ["size"], "color", ["red", "blue"], then_value="amount", else_value="null", agg="count", distinct=True)
    assert rows(pivoted) == [("M", 1, 0), ("S", 1, 1)]


def test_pivot_without_alias_and_with_backslash(sizes):
    columns = reshape.pivot_columns("color", ["a\\b", "it's"], alias=False)
    assert sizes.agg(*columns).first() is not None


def test_pivot_fixed_gives_null_where_nothing_matches(sizes, rows):
    assert rows(reshape.pivot_fixed(sizes, ["size"], "color", "amount", {"red": "r", "green": "g"})) == [("M", 4, None), ("S", 1, None)]


def test_unpivot_casts_and_keeps_nulls(table, rows):
    df = table("id int, name string, age int, active boolean", (1, "a", None, True), (2, "b", 30, False))
    long = reshape.unpivot(df, exclude=["id"], remove=["NAME"], field_name="prop", value_name="val")
    assert long.columns == ["id", "prop", "val"]
    assert rows(long) == [(1, "active", "true"), (1, "age", None), (2, "active", "false"), (2, "age", "30")]


def test_star_and_filtered_columns(table, rows):
    df = table("field_1 int, field_2 int, Field_3 int", (1, 2, 3))
    assert reshape.filtered_columns(df, ["FIELD_1"]) == ["field_2", "Field_3"]
    assert reshape.star(df, ["field_3"], "p_", "_s").columns == ["p_field_1_s", "p_field_2_s"]
    assert df.alias("t").select(*reshape.star_columns(df, ["field_1"], relation_alias="t")).columns == ["field_2", "Field_3"]
    assert reshape.star(df, df.columns).columns == []


def test_nullcheck_table(table, rows):
    df = table("a string, b string, c int", ("", "x", 1), (None, "", 2))
    assert rows(reshape.nullcheck_table(df)) == [(None, None, 2), (None, "x", 1)]


def test_group_by_first(table, rows):
    df = table("a string, b string, n int", ("x", "y", 1), ("x", "y", 2))
    assert rows(reshape.group_by_first(df, 2).agg(F.sum("n").alias("n"))) == [("x", "y", 3)]


# --- unions ---


@pytest.fixture
def relations(table):
    return {
        "t1": table("id int, name string, favorite_color string", (1, "drew", "pink"), (2, "bob", None)),
        "t2": table("ID int, name string, favorite_number int", (1, "ann", 7), (3, "joe", 9)),
    }


def test_union_covers_all_columns(relations, rows):
    union = unions.union_relations(relations)
    assert union.columns == ["source_relation", "id", "name", "favorite_color", "favorite_number"]
    assert rows(union) == [
        ("t1", 1, "drew", "pink", None),
        ("t1", 2, "bob", None, None),
        ("t2", 1, "ann", None, 7),
        ("t2", 3, "joe", None, 9),
    ]


def test_union_include_exclude_override_where(relations, rows):
    included = unions.union_relations(relations, include=["Id"], source_column_name=None, column_override={"ID": "string"}, where="id > 1")
    assert included.dtypes == [("id", "string")]
    assert rows(included) == [("2",), ("3",)]
    assert unions.union_relations(relations, exclude=["name"]).columns == ["source_relation", "id", "favorite_color", "favorite_number"]


def test_union_where_may_use_a_column_that_is_left_out(relations, rows):
    assert rows(unions.union_relations(relations, include=["id"], where="name = 'joe'")) == [("t2", 3)]


def test_union_keeps_the_first_type(table):
    union = unions.union_relations({"a": table("x string", ("1",)), "b": table("x int", (2,))})
    assert union.dtypes[1] == ("x", "string")


@pytest.mark.parametrize("options", [{"include": ["a"], "exclude": ["b"]}, {"include": ["nothing"]}])
def test_union_refuses(relations, options):
    with pytest.raises(ValueError):
        unions.union_relations(relations, **options)


def test_relations_by_pattern(spark, table, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS events_db")
    for name in ("events_db.data_events_20180101", "events_db.data_events_20180102", "events_db.other"):
        table("user_id int, event string", (1, name[-1])).write.mode("overwrite").saveAsTable(name)
    table("user_id int", (9,)).createOrReplaceTempView("data_events_view")
    stored = ["events_db.data_events_20180101", "events_db.data_events_20180102"]
    assert unions.relations_by_pattern(spark, "EVENTS_%", "data_events_2018%") == stored
    assert unions.relations_by_prefix(spark, "events_db", "data_events", exclude="%02") == ["data_events_view", stored[0]]
    assert unions.relations_by_pattern(spark, "nowhere", "data_events_2018%") == []
    named = [f"spark_catalog.{name}" for name in stored]
    assert unions.relations_by_pattern(spark, "events_%", "data_events_2018%", catalog="spark_catalog") == named
    assert unions.union_tables(spark, stored, include=["user_id"]).count() == 2
    spark.catalog.dropTempView("data_events_view")
    spark.sql("DROP DATABASE events_db CASCADE")


# --- dedupe ---


def test_deduplicate_keeps_rows_with_nulls(table, rows):
    df = table("user_id int, version int, note string", (1, 1, "a"), (1, 2, None), (2, 1, "c"))
    assert rows(dedupe.deduplicate(df, ["user_id"], [F.col("version").desc()])) == [(1, 2, None), (2, 1, "c")]


def test_latest_per_key_is_the_same_in_any_row_order(table, rows):
    data = [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("k", None, "z")]
    for order in (data, data[::-1]):
        assert rows(dedupe.latest_per_key(table("k string, t int, v string", *order), ["k"], ["t"])) == [("k", 2, "c")]


def test_deduplicate_thins_out_keys_before_the_shuffle(table):
    df = table("k string, t int", ("a", 1))
    plan = dedupe.deduplicate(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial, "the partial limit should run below the exchange"


# --- driver reads ---


@pytest.fixture
def fields(table):
    return table("field string, condition string", *[(c, "left") for c in "abcdef"], *[("g", "right")] * 5)


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_most_frequent_values(spark, buckets):
    """Few buckets leave many candidates, but the result is that of counting everything."""
    values = [i * i % 83 if i % 3 else i for i in range(2000)] + [None] * 40 + [5] * 300
    df = spark.createDataFrame([(v, v % 2 == 0 if v is not None else None) for v in values], "v int, even boolean")
    for most, where in ((1, None), (10, None), (10, "even"), (5000, None), (3, "false")):
        wanted = introspect.value_frequencies(df, "v", max_records=most, where=where).collect()
        assert introspect.most_frequent(df, "v", most, where, buckets).collect() == wanted


def test_light_values_are_not_shuffled_by_value(spark):
    df = spark.range(20_000).selectExpr("if(id % 4 = 0, id % 3, id) AS v")
    found = introspect.most_frequent(df, "v", 3)
    assert [row.n_rows for row in found.collect()] == [1668, 1667, 1667]
    kept = found._jdf.queryExecution().executedPlan().toString()
    assert kept.count("LeftSemi") >= 2


def test_values_are_numbered_in_order(spark, fields):
    for terms in ("count(*) desc", [(F.count(F.lit(1)), "desc")], [F.min("field")], ["FIELD desc"], ["max(field)", "count(*)"]):
        plain = introspect.value_frequencies(fields, "field", terms).collect()
        placed = introspect.value_frequencies(fields, "field", terms, place="n").collect()
        assert [tuple(row) for row in placed] == [(*row, i) for i, row in enumerate(plain, 1)]
        few = introspect.value_frequencies(fields, "field", terms, max_records=3, place="n").collect()
        assert [tuple(row) for row in few] == [tuple(row) for row in placed[:3]]
    many = introspect.numbered(spark.range(5000).selectExpr("(id * 7919) % 5003 AS v"), [F.col("v").desc()], "n").collect()
    assert [row.n for row in sorted(many, key=lambda row: -row.v)] == list(range(1, 5001))


def test_column_values(fields):
    assert introspect.column_values(fields, "field") == ["g", *"abcdef"]
    assert introspect.column_values(fields, "field", order_by="field desc", max_records=2) == ["g", "f"]
    assert introspect.column_values(fields, "field", order_by="count(*) asc", max_records=2) == ["a", "b"]
    assert introspect.column_values(fields, "field", where="condition = 'right'") == ["g"]
    assert introspect.column_values(fields, "field", order_by=["count(*) desc", "max(concat(field, ',')) desc"]) == [*"gfedcba"]
    placed = introspect.value_frequencies(fields, "field", ["max(condition) desc", "field desc"], max_records=2, place="place")
    assert [(row.value, row.place) for row in placed.collect()] == [("g", 1), ("f", 2)]
    assert introspect.column_values(fields, "field", where="false", default=["none"]) == ["none"]
    assert introspect.column_values(None, "field", default=[]) == []
    with pytest.raises(ValueError):
        introspect.column_values(None, "field")
    with pytest.raises(ValueError):
        introspect.column_values(fields, "field", max_rows=3)


def test_single_value_and_dict(fields, table):
    assert introspect.single_value(fields.orderBy("field")) == "a"
    assert introspect.single_value(introspect.empty_like(fields), default=7) == 7
    df = table("col_1 int, col_3 boolean", (1, True), (2, None)).orderBy("col_1")
    assert introspect.as_dict(df) == {"col_1": (1, 2), "col_3": (True, None)}


def test_latest_and_distinct(fields, rows):
    assert introspect.latest(fields, "field").first()[0] == "g"
    assert [row[0] for row in introspect.distinct_sorted(fields, "field").collect()] == list("abcdefg")
    assert introspect.empty_like(fields).schema == fields.schema
