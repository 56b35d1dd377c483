from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import session
from tidemark.sources import candidates, landing, payloads, schemas, tables
from tidemark.streaming import landing as stream

LOADED = "2024-01-01T00:00:00"


@pytest.fixture
def documents(spark):
    return lambda *docs: spark.createDataFrame([(doc if isinstance(doc, str) else json.dumps(doc),) for doc in docs], "payload string")


# --- payloads ---


def test_sgs(documents, rows):
    raw = documents([{"data": "01/02/2020", "valor": "1.5"}, {"data": "01/03/2020", "valor": ""}], "not json", [])
    flat = payloads.flatten_sgs(raw, "selic_mensal", "% a.a.", loaded_at=LOADED)
    assert flat.columns == schemas.SERIES_SCHEMA.names
    assert rows(flat) == [
        ("bcb", "selic_mensal", "2020-02-01", 2020, 2, 1.5, "% a.a.", LOADED),
        ("bcb", "selic_mensal", "2020-03-01", 2020, 3, None, "% a.a.", LOADED),
    ]


def test_sgs_files_are_read_item_by_item(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(json.dumps([{"data": "01/02/2020", "valor": "1"}, {"data": "31/12/2020", "valor": "2"}], indent=1))
    items = payloads.read_sgs(spark, str(tmp_path))
    assert items.count() == 2
    whole = payloads.flatten_sgs(payloads.read_payloads(spark, str(tmp_path)), "x", "u", loaded_at=LOADED)
    assert rows(payloads.sgs_rows(items, "x", "u", loaded_at=LOADED)) == rows(whole)


def sidra(*series):
    return [{"resultados": [{"series": [{"localidade": {"nome": name}, "serie": serie} for name, serie in series]}]}]


def test_sidra_takes_the_first_series_and_drops_missing_figures(documents, rows):
    raw = documents(
        sidra(("BR", {"2020": "1.0", "202001": "2.0", "202002": "...", "202003": "", "202004": None}), ("other", {"2020": "9"})), [], [{"resultados": []}]
    )
    flat = payloads.flatten_sidra(raw, "pib_variacao_pct", "%", loaded_at=LOADED)
    assert flat.columns == schemas.GDP_SCHEMA.names
    assert rows(flat) == [
        ("ibge", "pib_variacao_pct", "2020", 2020, None, 1.0, "%", LOADED),
        ("ibge", "pib_variacao_pct", "2020-T1", 2020, 1, 2.0, "%", LOADED),
    ]


def test_sidra_by_region_keeps_missing_figures(documents, rows):
    raw = documents(sidra(("Acre", {"2022": "5", "2021": "4"}), ("Bahia", {"2022": "..."}), ("Ceara", {})), [])
    flat = payloads.flatten_sidra_region(raw, "populacao", "pessoas", F.lit(2022), loaded_at=LOADED)
    assert flat.columns == schemas.POPULATION_SCHEMA.names
    assert [row[2:5] for row in rows(flat)] == [("Acre", 2022, 5.0), ("Bahia", 2022, None), ("Ceara", 2022, None)]


def test_odata(documents, rows):
    items = [("2020-05-01T00:00:00-03:00", 7.5), ("2009-12-01", 1.0), ("", 1.0), ("bad date", 1.0), ("2020-06-01", None)]
    raw = documents({"value": [{"VALDATA": day, "VALVALOR": value} for day, value in items]}, {"value": []})
    flat = payloads.flatten_odata(raw, "desemprego_pct", "%", loaded_at=LOADED)
    assert flat.columns == schemas.SERIES_SCHEMA.names
    assert rows(flat) == [("ipea", "desemprego_pct", "2020-05-01", 2020, 5, 7.5, "%", LOADED)]


def test_load_time_defaults_to_now(documents):
    flat = payloads.flatten_sgs(documents([{"data": "01/02/2020", "valor": "1"}]), "x", "u")
    assert flat.first().dt_carga > "2024"


# --- fallback ---


def test_first_nonempty(table, rows):
    empty, second, third = table("k string, v int"), table("k string, v int", ("a", 2)), table("k string, v int", ("a", 3), ("b", 3), (None, 3))
    assert rows(landing.first_nonempty([empty, second, third])) == [("a", 2)]
    assert rows(landing.first_nonempty([empty, second, third], by=["k"])) == [(None, 3), ("a", 2), ("b", 3)]
    assert rows(landing.first_nonempty([empty, empty])) == []
    with pytest.raises(ValueError):
        landing.first_nonempty([])


def test_a_hot_key_is_split_when_choosing_by_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    apart = spark.newSession()
    for name, setting in settings.items():
        apart.conf.set(name, setting)
    df = apart.range(0, 1_000_000, 1, 16).selectExpr("if(id % 3 = 0, 7, id) AS k", "xxhash64(id) AS v")
    chosen = landing.first_nonempty([df.filter("v % 5 = 1"), df], by=["k"]).agg(F.sum(F.hash("v")))
    chosen.collect()
    assert "skew=true" in chosen._jdf.queryExecution().executedPlan().toString()


# --- candidates ---


@pytest.fixture
def payload(tmp_path):
    def put(source, place, document):
        return write(tmp_path / "payloads" / source / str(place) / "a.json", document if isinstance(document, str) else json.dumps(document))

    return put


def test_the_first_candidate_with_rows_is_landed(spark, tmp_path, payload, rows):
    payload("ibge_pib", 0, [])
    payload("ibge_pib", 1, "not json")
    payload("ibge_pib", 2, sidra(("BR", {"202001": "1.5", "202002": "..."})))
    payload("ibge_pib", 3, [{"data": "01/01/2020", "valor": "9"}])
    payload("ipea_gini", 0, {"value": []})
    payload("ipea_gini", 3, [{"data": "01/02/2020", "valor": "7"}, {"data": "01/03/2020", "valor": ""}])
    payload("ibge_populacao", 1, sidra(("Acre", {"2021": "5"})))
    payload("bcb_selic", 0, [])
    raw = str(tmp_path / "raw")
    landed = candidates.land_sources(spark, str(tmp_path / "payloads"), raw)
    assert landed == ["ibge_pib", "ibge_populacao", "bcb_selic", "ipea_gini"]
    read = lambda name, schema: landing.read_series_csv(spark, f"{raw}/{name}.csv", schema)
    assert rows(read("ibge_pib", schemas.GDP_FIELDS).select("periodo", "trimestre", "valor", "mes")) == [("2020-T1", 1, 1.5, None)]
    assert rows(read("ipea_gini", schemas.SERIES_SCHEMA).select("indicador", "data", "valor")) == [
        ("renda_media_pc", "2020-02-01", 7.0),
        ("renda_media_pc", "2020-03-01", None),
    ]
    assert rows(read("ibge_populacao", schemas.POPULATION_SCHEMA).select("uf", "ano", "valor")) == [("Acre", 2021, 5.0)]
    assert read("bcb_selic", schemas.SERIES_SCHEMA).isEmpty()


def test_the_last_resort_of_a_chain(spark, tmp_path, payload, rows):
    payload("ibge_pib", 2, [{"resultados": []}])
    payload("ibge_pib", 3, [{"data": "01/04/2020", "valor": "9"}])
    raw = str(tmp_path / "raw")
    assert candidates.land_sources(spark, str(tmp_path / "payloads"), raw, ["ibge_pib", "bcb_ipca"]) == ["ibge_pib"]
    found = landing.read_series_csv(spark, f"{raw}/ibge_pib.csv", schemas.GDP_FIELDS)
    assert rows(found.select("fonte", "indicador", "data", "mes", "periodo")) == [("bcb", "pib_variacao_pct", "2020-04-01", 4, None)]


def test_long_periods_are_not_cut(documents, rows):
    flat = payloads.flatten_sidra(documents(sidra(("BR", {"20200000000001": "1.0", "202099999999999999": "2.0"}))), "x", "%", loaded_at=LOADED)
    assert rows(flat.select("periodo", "trimestre", "valor")) == [("2020", None, 2.0), ("2020-T1", 1, 1.0)]


# --- landing files ---


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


MONTHLY_CSV = "fonte,indicador,data,ano,mes,valor,unidade,dt_carga\nbcb,pib_variacao_pct,2020-03-01,2020,3,1.5,%,x\nbcb,pib_variacao_pct,2020-04-01,2020,4,bad,%,x\n"


def test_headers_bind_by_name(spark, tmp_path, rows):
    """Monthly rows in the GDP file keep their month; by position it lands in the quarter."""
    path = write(tmp_path / "ibge_pib.csv", MONTHLY_CSV)
    named = landing.read_series_csv(spark, path, schemas.GDP_FIELDS).select("periodo", "data", "mes", "trimestre", "valor")
    assert rows(named) == [(None, "2020-03-01", 3, None, 1.5), (None, "2020-04-01", 4, None, None)]
    placed = landing.read_series_csv(spark, path, schemas.GDP_SCHEMA, bind="position").select("periodo", "trimestre", "valor")
    assert rows(placed) == [("2020-03-01", 3, 1.5), ("2020-04-01", 4, None)]
    with pytest.raises(ValueError):
        landing.read_series_csv(spark, path, schemas.GDP_SCHEMA, bind="guess")


def test_files_without_rows(spark, tmp_path):
    header = write(tmp_path / "a.csv", "fonte,valor\n")
    empty = write(tmp_path / "b.csv", "")
    for path in (header, empty):
        df = landing.read_series_csv(spark, path, schemas.SERIES_SCHEMA)
        assert df.isEmpty() and df.columns == schemas.SERIES_SCHEMA.names


def test_mixed_headers_under_one_path_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "fonte,valor\nx,1\n")
    write(tmp_path / "b.csv", "valor,fonte\n1,x\n")
    with pytest.raises(Exception, match="header"):
        landing.read_series_csv(spark, str(tmp_path), schemas.SERIES_SCHEMA).collect()


def test_csv_roundtrip_and_inference(spark, table, tmp_path, rows):
    df = table("k string, n int", ("a,b", 1), ('q"x', 2))
    landing.write_csv(df, str(tmp_path / "out"))
    back = landing.read_inferred_csv(spark, str(tmp_path / "out"))
    assert rows(back) == rows(df) and dict(back.dtypes)["n"] == "int"


def test_values_with_newlines_quotes_and_nothing_survive_csv(spark, table, tmp_path, rows):
    df = table("k string, v string", ("a\nb", 'say "x"'), ("", None), (None, ""), ("c,d", "\\"), ('"', "e\r\nf"))
    landing.write_csv(df, str(tmp_path / "out.csv"))
    schema = df.schema
    assert rows(landing.read_series_csv(spark, str(tmp_path / "out.csv"), schema)) == rows(df)
    assert rows(landing.read_series_csv(spark, str(tmp_path / "out.csv"), schema, bind="position")) == rows(df)
    assert rows(landing.landed_rows(spark, str(tmp_path))) == [("out.csv", 5)]


def test_control_characters_are_values(spark, table, tmp_path, rows):
    path = str(tmp_path / "control")
    landing.write_csv(table("a string, b int", ("\u0001", 1), ("", 2), (None, 3)), path)
    found = landing.read_series_csv(spark, path, StructType.fromDDL("a string, b int"))
    assert rows(found) == [(None, 3), ("", 2), ("\u0001", 1)]


def test_the_gate_counts_records_of_files_that_parse(spark, tmp_path, rows):
    write(tmp_path / "a_quoted.csv", 'k,v\n"x\ny",1\n"z",2\n')
    write(tmp_path / "b_ragged.csv", "k,v\n" + "1,2\n" * 20 + "1,2,\n")
    write(tmp_path / "c_short.csv", "k,v\n1\n2,3\n")
    write(tmp_path / "d_empty.csv", "")
    assert rows(landing.landed_rows(spark, str(tmp_path))) == [("a_quoted.csv", 2), ("b_ragged.csv", 0), ("c_short.csv", 2), ("d_empty.csv", 0)]
    assert landing.landed_rows(spark, str(tmp_path / "none")).collect() == []


def test_gate(spark, tmp_path, rows):
    lines = lambda n: "a,b\n" + "1,2\n" * n
    write(tmp_path / "bcb_selic.csv", lines(7))
    write(tmp_path / "bcb_ipca.csv", lines(3))
    write(tmp_path / "bcb_cambio.csv", "a\n")
    write(tmp_path / "ipea_gini.csv", "x,y,z\n" + "1,2,3\n" * 9)
    write(tmp_path / "other.csv", lines(50))
    counts = landing.landed_rows(spark, str(tmp_path))
    gate = landing.gate_rows(counts, ["bcb", "ipea", "ibge"])
    assert rows(gate.select("source", "n_rows", "passed")) == [("bcb", 10, True), ("ibge", 0, False), ("ipea", 9, False)]
    assert landing.gated_files(spark, str(tmp_path), ["bcb", "ipea"]) == {"bcb_selic.csv": 7, "bcb_ipca.csv": 3, "bcb_cambio.csv": 0}
    assert landing.gated_files(spark, str(tmp_path / "none"), ["bcb"]) == {}


# --- bronze ---


def test_bronze_appends_evolve_and_are_stamped(spark, table, tmp_path, rows):
    path = str(tmp_path / "bronze")
    assert landing.load_if_present(spark, path) is None
    assert landing.append_bronze(landing.stamp(table("a int", (1,), (2,)), "first", "2024-01-01"), path) == 2
    assert landing.append_bronze(landing.stamp(table("a int, b string", (3, "x")), "second"), path) == 1
    df = landing.load_if_present(spark, path)
    assert rows(df.select("a", "b", "_source")) == [(1, None, "first"), (2, None, "first"), (3, "x", "second")]
    assert df.filter("_loaded_at is null").isEmpty()


def test_a_bronze_table_without_rows_is_skipped(spark, table, tmp_path):
    landing.append_bronze(table("a int"), str(tmp_path / "none"))
    assert landing.load_if_present(spark, str(tmp_path / "none")) is None
    os.makedirs(tmp_path / "bare")
    assert landing.load_if_present(spark, str(tmp_path / "bare")) is None


def test_source_selection():
    assert [source.name for source in schemas.select_sources(["bcb_ipca"])] == ["bcb_ipca"]
    assert len(schemas.select_sources()) == 7
    with pytest.raises(KeyError):
        schemas.select_sources(["nobody"])


# --- tables ---

TABLE = "chave string, fonte string, ano int, valor double"


def stored(spark, path):
    return tables.load(spark, path, schema=TABLE).select("chave", "fonte", "ano", "valor")



def test_upsert_is_exact_and_repeatable(spark, table, tmp_path, rows):
    path = str(tmp_path / "silver")
    base = table(TABLE, ("a", "01", 2020, 1.0), ("b", "01", 2020, 2.0), ("c", "02", 2021, 3.0), ("d", None, 2020, 4.0))
    tables.upsert(spark, path, base, ["chave"], ["fonte", "ano"])
    untouched = {name for name in os.listdir(path + "/fonte=01/ano=2020")}
    # c moves to another partition and leaves its old one empty; d has a null partition; e is new.
    batch = table(TABLE, ("c", "03", 2022, 30.0), ("d", None, 2020, 40.0), ("e", "03", 2022, 50.0))
    wanted = [("a", "01", 2020, 1.0), ("b", "01", 2020, 2.0), ("c", "03", 2022, 30.0), ("d", None, 2020, 40.0), ("e", "03", 2022, 50.0)]
    for _ in range(2):
        tables.upsert(spark, path, batch, ["chave"], ["fonte", "ano"])
        assert rows(stored(spark, path)) == wanted
    assert {name for name in os.listdir(path + "/fonte=01/ano=2020")} == untouched, "other partitions are not rewritten"


def test_upsert_of_partitions_in_several_scans(spark, table, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(tables, "PARTITIONS_AT_ONCE", 1)
    path = str(tmp_path / "silver")
    tables.upsert(spark, path, table(TABLE, ("a", "x", 1, 1.0), ("b", "y", 2, 2.0), ("c", "z", 3, 3.0)), ["chave"], ["fonte", "ano"])
    tables.upsert(spark, path, table(TABLE, ("a", "w", 9, 10.0), ("b", "y", 2, 20.0)), ["chave"], ["fonte", "ano"])
    assert rows(stored(spark, path)) == [("a", "w", 9, 10.0), ("b", "y", 2, 20.0), ("c", "z", 3, 3.0)]


def test_upsert_adds_columns(spark, table, tmp_path, rows):
    path = str(tmp_path / "silver")
    tables.upsert(spark, path, table(TABLE, ("a", "x", 1, 1.0), ("b", "y", 1, 1.0)), ["chave"], ["fonte", "ano"])
    tables.upsert(spark, path, table(TABLE + ", nota string", ("a", "x", 1, 2.0, "n")), ["chave"], ["fonte", "ano"])
    merged = spark.read.option("mergeSchema", True).parquet(path).select("chave", "valor", "nota")
    assert rows(merged) == [("a", 2.0, "n"), ("b", 1.0, None)]


def test_upsert_refuses_repeated_keys(spark, table, tmp_path):
    batch = table(TABLE, ("a", "x", 1, 1.0), ("a", "x", 1, 2.0))
    with pytest.raises(ValueError, match="'a'"):
        tables.upsert(spark, str(tmp_path / "silver"), batch, ["chave"], ["fonte", "ano"])


@pytest.mark.parametrize("step", ["publish", "remove_path"])
def test_an_upsert_that_breaks_off_is_completed_by_the_next_one(spark, table, tmp_path, rows, monkeypatch, step):
    path = str(tmp_path / "silver")
    tables.upsert(spark, path, table(TABLE, ("a", "x", 1, 1.0), ("b", "y", 1, 1.0)), ["chave"], ["fonte", "ano"])

    def fail(*_):
        raise OSError("disk")

    with monkeypatch.context() as patched:
        patched.setattr(tables, step, fail)
        with pytest.raises(OSError):
            tables.upsert(spark, path, table(TABLE, ("a", "z", 2, 2.0)), ["chave"], ["fonte", "ano"])
    if step == "publish":
        assert rows(stored(spark, path)) == [("a", "x", 1, 1.0), ("b", "y", 1, 1.0)]
    tables.upsert(spark, path, table(TABLE, ("c", "y", 1, 3.0)), ["chave"], ["fonte", "ano"])
    assert rows(stored(spark, path)) == [("a", "z", 2, 2.0), ("b", "y", 1, 1.0), ("c", "y", 1, 3.0)]
    assert not tables.finish_upsert(spark, path)


def test_upsert_with_null_and_empty_partitions(spark, table, tmp_path, rows):
    """Both lie in one folder, so neither may push the other out."""
    path = str(tmp_path / "silver")
    tables.upsert(spark, path, table(TABLE, ("a", None, 1, 1.0), ("b", "x", 1, 2.0), ("c", "", 1, 3.0)), ["chave"], ["fonte", "ano"])
    tables.upsert(spark, path, table(TABLE, ("d", "", 1, 4.0)), ["chave"], ["fonte", "ano"])
    assert rows(stored(spark, path)) == [("a", None, 1, 1.0), ("b", "x", 1, 2.0), ("c", None, 1, 3.0), ("d", None, 1, 4.0)]
    tables.upsert(spark, path, table(TABLE, ("a", "x", 1, 5.0)), ["chave"], ["fonte", "ano"])
    assert rows(stored(spark, path)) == [("a", "x", 1, 5.0), ("b", "x", 1, 2.0), ("c", None, 1, 3.0), ("d", None, 1, 4.0)]


def test_upsert_keeps_columns_that_the_batch_lacks(spark, table, tmp_path, rows):
    path = str(tmp_path / "silver")
    tables.upsert(spark, path, table(TABLE + ", nota string", ("a", "x", 1, 1.0, "n"), ("b", "x", 1, 1.0, "m")), ["chave"], ["fonte", "ano"])
    tables.upsert(spark, path, table(TABLE, ("a", "y", 1, 2.0), ("c", "x", 1, 3.0)), ["chave"], ["fonte", "ano"])
    found = spark.read.option("mergeSchema", True).parquet(path).select("chave", "fonte", "valor", "nota")
    assert rows(found) == [("a", "y", 2.0, "n"), ("b", "x", 1.0, "m"), ("c", "x", 3.0, None)]


def test_equal_rows_rewrite_no_partition(spark, table, tmp_path, rows):
    path, schema = str(tmp_path / "silver"), TABLE + ", _at int"
    tables.upsert(spark, path, table(schema, ("a", "x", 1, None, 1), ("b", "y", 1, 2.0, 1)), ["chave"], ["fonte", "ano"])
    files = lambda: {(d, n, os.stat(os.path.join(d, n)).st_mtime_ns) for d, _, names in os.walk(path) for n in names if "part-" in n}
    before = files()
    tables.upsert(spark, path, table(schema, ("a", "x", 1, None, 2), ("b", "y", 1, 2.0, 2)), ["chave"], ["fonte", "ano"], ignore=["_at"])
    assert files() == before
    tables.upsert(spark, path, table(schema, ("a", "x", 1, None, 2), ("b", "y", 1, 3.0, 2)), ["chave"], ["fonte", "ano"], ignore=["_at"])
    assert {f for f in files() if "fonte=x" in f[0]} == {f for f in before if "fonte=x" in f[0]}
    assert rows(stored(spark, path)) == [("a", "x", 1, None), ("b", "y", 1, 3.0)]
    with pytest.raises(ValueError, match="'b'"):
        tables.upsert(spark, path, table(schema, ("b", "y", 1, 3.0, 2), ("b", "y", 1, 4.0, 2)), ["chave"], ["fonte", "ano"], ignore=["_at"])


def test_export_view_and_stored_query(spark, table, tmp_path, rows):
    df = table("a int, b string", (1, "x"), (2, "y"))
    tables.export_parquet(df, str(tmp_path / "export"))
    tables.register_view(spark, "exported", str(tmp_path / "export"))
    for path in (None, str(tmp_path / "stored")):
        tables.create_table_as(spark.sql("SELECT a FROM exported WHERE b = 'y'"), "stored_query", path)
        assert rows(spark.table("stored_query")) == [(2,)]
    assert tables.first_existing_schema(spark, ["nowhere", "default"], "stored_query") == "default"
    assert tables.first_existing_schema(spark, ["nowhere"], "stored_query") is None
    spark.sql("DROP TABLE stored_query")


def test_partition_filters_reach_the_scan(spark, table, tmp_path):
    path = str(tmp_path / "parts")
    tables.write_partitioned(table(TABLE, ("a", "x", 1, 1.0), ("b", "y", 2, 2.0)), path, ["fonte", "ano"])
    plan = tables.load(spark, path).filter("ano >= 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_a_stored_query_survives_a_run_that_broke_off(spark, table, rows):
    tables.create_table_as(table("a int", (1,)), "broken_off")
    spark.sql("ALTER TABLE broken_off RENAME TO broken_off__replaced")
    tables.create_table_as(table("a int", (2,)), "broken_off")
    tables.create_table_as(table("a int", (0,)), "broken_off__replaced")
    tables.create_table_as(table("a int", (3,)), "broken_off")
    assert rows(spark.table("broken_off")) == [(3,)]
    assert not spark.catalog.tableExists("broken_off__replaced")
    spark.sql("DROP TABLE broken_off")


def test_shared_folder_is_the_configured_one(spark, table, tmp_path, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(configured)
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    session.materialise(table("a int", (1,)), "x")
    assert os.listdir(tmp_path / spark.sparkContext.applicationId)
    session.clear_scratch(spark)
    assert not (tmp_path / spark.sparkContext.applicationId).exists()


# --- new files only ---


def test_stream_and_batch_appends_make_one_table(spark, tmp_path, rows):
    raw, bronze, state = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "state")
    batch = landing.read_series_csv(spark, write(tmp_path / "old.csv", MONTHLY_CSV), schemas.SERIES_SCHEMA)
    landing.append_bronze(landing.stamp(batch, "bcb_selic"), bronze)
    write(raw / "a.csv", MONTHLY_CSV)

    def load():
        stream.append_new(stream.landing_files(spark, str(raw)), bronze, schemas.SERIES_SCHEMA, "ibge_pib", state).awaitTermination()
        return landing.read_bronze(spark, bronze).count()

    assert load() == 4
    assert load() == 4
    # Another column order: bound by header, not by position.
    write(raw / "b.csv", "valor,data,fonte,indicador\n7.5,2021-01-01,bcb,pib_variacao_pct\n")
    assert load() == 5
    assert rows(landing.read_bronze(spark, bronze).filter("ano is null").select("data", "valor", "_source")) == [("2021-01-01", 7.5, "ibge_pib")]


def test_a_repeated_batch_is_not_appended_again(spark, tmp_path):
    raw, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    write(raw / "a.csv", MONTHLY_CSV)
    state = tmp_path / "state"
    stream.append_new(stream.landing_files(spark, str(raw)), bronze, schemas.SERIES_SCHEMA, "s", str(state)).awaitTermination()
    for name in ("commits/0", "commits/.0.crc"):  # as if it had failed after the append
        (state / name).unlink()
    stream.append_new(stream.landing_files(spark, str(raw)), bronze, schemas.SERIES_SCHEMA, "s", str(state)).awaitTermination()
    assert landing.read_bronze(spark, bronze).count() == 2


def test_stream_upserts_by_key(spark, tmp_path, rows):
    raw, path, state = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "state")
    schema = spark.createDataFrame([], TABLE).schema

    def load():
        files = stream.landing_files(spark, str(raw))
        stream.upsert_new(files, path, schema, "s", ["chave"], ["valor"], ["fonte", "ano"], state).awaitTermination()
        return rows(stored(spark, path))

    write(raw / "a.csv", "chave,fonte,ano,valor\na,x,2020,1\na,x,2020,2\nb,x,2020,3\n")
    assert load() == [("a", "x", 2020, 2.0), ("b", "x", 2020, 3.0)]
    write(raw / "b.csv", "ano,valor,chave,fonte\n2021,4,b,y\n")
    assert load() == [("a", "x", 2020, 2.0), ("b", "y", 2021, 4.0)]
