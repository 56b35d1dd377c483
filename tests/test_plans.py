from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import dashboard, marts, medallion, silver

LANDING = "fonte string, indicador string, data string, ano int, mes int, valor double, unidade string, dt_carga string, _loaded_at timestamp"
GDP = "fonte string, indicador string, periodo string, ano int, trimestre int, valor double, unidade string, dt_carga string, _loaded_at timestamp"
EARLY, LATE = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def month(name, year, mes, value, loaded=EARLY):
    return ("bcb", name, f"{year}-{mes:02d}-01", year, mes, value, "%", loaded.isoformat(), loaded)


def quarter(year, q, value, loaded=EARLY):
    return ("ibge", "pib", f"{year}-T{q}" if q else str(year), year, q, value, "%", loaded.isoformat(), loaded)


@pytest.fixture
def observations(table):
    monthly = table(
        LANDING,
        month("ipca", 2019, 1, 2.0),
        month("ipca", 2020, 1, 3.0),
        month("ipca", 2020, 1, 4.0, LATE),
        month("ipca", 2022, 1, 1.0),
        month("ipca", 2023, 1, None),
        month("selic", 2019, 1, 0.0),
        month("selic", 2020, 1, 5.0),
        month("selic", 2021, 1, -5.0),
        month("selic", 2022, 1, -4.0),
    )
    quarterly = table(GDP, quarter(2019, 1, 1.0), quarter(2019, 2, 10.0), quarter(2020, 1, 2.0), quarter(2020, 2, 5.0), quarter(2021, None, 7.0))
    return silver.silver({"monetario": monthly, "atividade": quarterly})


def test_silver_shape(observations):
    assert observations.columns == silver.OBSERVATION_COLUMNS + ["variacao_yoy", "_silver_at"]
    assert observations.filter("valor is null").isEmpty()


def test_newest_load_wins_and_yearly_change(observations, rows):
    changes = rows(observations.select("chave", "valor", "variacao_yoy"))
    assert changes == [
        ("ipca_2019-01-01", 2.0, None),
        ("ipca_2020-01-01", 4.0, 100.0),
        ("ipca_2022-01-01", 1.0, -75.0),  # against 2020: the gap goes unnoticed
        ("pib_2019-T1", 1.0, None),
        ("pib_2019-T2", 10.0, None),
        ("pib_2020-T1", 2.0, 100.0),
        ("pib_2020-T2", 5.0, -50.0),
        ("pib_2021", 7.0, None),
        ("selic_2019-01-01", 0.0, None),
        ("selic_2020-01-01", 5.0, None),  # nothing to divide by
        ("selic_2021-01-01", -5.0, -200.0),
        ("selic_2022-01-01", -4.0, 20.0),
    ]


def test_strict_change_needs_the_year_before(table, rows):
    df = table(LANDING, month("ipca", 2020, 1, 4.0), month("ipca", 2022, 1, 1.0), month("ipca", 2023, 1, 2.0))
    for split in (False, True):
        strict = silver.silver({"monetario": df}, strict=True, split=split)
        assert [row[0] for row in strict.orderBy("ano").select("variacao_yoy").collect()] == [None, None, 100.0]


def test_harmonise_takes_monthly_rows_from_a_mixed_table(table, rows):
    mixed = table(
        "fonte string, indicador string, periodo string, data string, ano int, mes int, trimestre int, valor double, unidade string",
        ("bcb", "pib", None, "2020-03-01", 2020, 3, None, 1.0, "%"),
        ("ibge", "pib", "2020-T1", None, 2020, None, 1, 2.0, "%"),
        ("ibge", "pib", None, None, 2020, None, None, 3.0, "%"),
    )
    found = silver.harmonise(mixed, "atividade").select("chave", "periodo", "mes", "trimestre")
    assert rows(found) == [("pib", None, None, None), ("pib_2020-03-01", "2020-03-01", 3, None), ("pib_2020-T1", "2020-T1", None, 1)]


def test_no_landing_table_is_an_error():
    with pytest.raises(ValueError):
        silver.silver({})


def test_panel(observations, rows):
    panel = marts.annual_panel(observations, {"ipca": "ipca_media", "pib": "pib_media", "none": "none_media"}, since=2020)
    assert rows(panel) == [(2020, 4.0, 3.5, None), (2021, None, 7.0, None), (2022, 1.0, None, None)]
    summary = marts.annual_summary(observations, 2020).filter("indicador = 'pib' and ano = 2020")
    assert rows(summary) == [(2020, "pib", 3.5, 2.0, 5.0, 2)]


def test_monthly_series_has_no_quarters(observations, rows):
    monthly = marts.monthly_series(observations)
    assert monthly.filter("indicador = 'pib'").isEmpty()
    trends = rows(monthly.select("periodo", "indicador", "tendencia").filter("indicador = 'selic'"))
    assert [row[2] for row in trends] == ["sem_dado", "sem_dado", "queda", "alta"]


def test_lagged_comparison(table, rows):
    df = table(
        "indicador string, ano int, mes int, valor double",
        ("cambio_usd_brl", 2020, 1, 5.0),
        ("ipca_mensal", 2020, 1, 1.0),
        ("cambio_usd_brl", 2020, 3, 6.0),
        ("ipca_mensal", 2020, 3, 2.0),
        ("cambio_usd_brl", 2021, 1, 4.0),
        ("selic_mensal", 2021, 1, 9.0),
        ("pib_variacao_pct", 2021, None, 9.0),
    )
    found = marts.lagged_comparison(df).select("ano", "selic_media", "ipca_media", "cambio_medio", "desemprego_medio", "cambio_vs_ipca_defasado")
    assert rows(found) == [(2020, None, 1.5, 5.5, None, 5.0), (2021, 9.0, None, 4.0, None, 2.0)]


def test_dashboard_reads(observations, table, rows):
    panel = table(
        "ano int, selic_media double, ipca_media double, cambio_medio double, desemprego_medio double, pib_variacao_media double",
        (2020, 1.0, 1.0, 1.0, 1.0, 1.0),
        (2021, 13.26, 0.456, 5.4, None, float("nan")),
    )
    assert rows(dashboard.latest_kpis(panel)) == [(2021, "13.3%", "0.46%", "R$ 5.40", "–", "–")]
    monthly = marts.monthly_series(observations)
    assert [row[0] for row in dashboard.indicator_names(monthly).collect()] == ["ipca", "selic"]
    chosen = dashboard.series_explorer(monthly, ["ipca"], with_change_only=True)
    assert [row.periodo_dt for row in chosen.collect()] == [dt.date(2020, 1, 1), dt.date(2022, 1, 1)]
    assert dashboard.series_explorer(monthly, []).count() == monthly.count()
    assert [row.ano for row in dashboard.by_year(panel).collect()] == [2020, 2021]


# --- the whole run ---


def land(folder, name, lines, header="fonte,indicador,data,ano,mes,valor,unidade,dt_carga"):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")


def series(agency, name, years, value=lambda y, m: y - 2000 + m / 10):
    return [f"{agency},{name},{y}-{m:02d}-01,{y},{m},{value(y, m)},%,2024" for y in years for m in range(1, 13)]


def test_whole_run(spark, tmp_path, rows):
    raw, base = tmp_path / "raw", str(tmp_path / "lake")
    land(raw, "bcb_selic", series("bcb", "selic_mensal", (2019, 2020)))
    land(raw, "bcb_ipca", series("bcb", "ipca_mensal", (2019, 2020)))
    land(raw, "bcb_cambio", [])
    land(raw, "ibge_pib", series("bcb", "pib_variacao_pct", (2019,)))  # the monthly stand-in
    land(raw, "ipea_gini", series("ipea", "renda_media_pc", (2019,))[:3])  # too few rows
    report = medallion.run(spark, str(raw), base)
    assert {row.status for row in report.collect()} == {"pass"} and report.count() == 7

    observed = spark.table("observations")
    counts = {row.indicador: row["count"] for row in observed.groupBy("indicador").count().collect()}
    assert counts == {"selic_mensal": 24, "ipca_mensal": 24, "pib_variacao_pct": 12}
    assert observed.filter("indicador = 'pib_variacao_pct' and mes is null").isEmpty()

    # A second load restates one indicator and keeps the history of the others.
    land(raw, "bcb_selic", series("bcb", "selic_mensal", (2020, 2021), lambda y, m: 100.0))
    medallion.run(spark, str(raw), base, ["bcb_selic"])
    observed = spark.table("observations")
    assert observed.groupBy("chave").count().filter("count > 1").isEmpty()
    by_year = rows(observed.filter("indicador = 'selic_mensal'").groupBy("ano").agg(F.avg("valor"), F.max("variacao_yoy")))
    assert [(row[0], row[1]) for row in by_year[1:]] == [(2020, 100.0), (2021, 100.0)]
    assert by_year[2][2] == 0.0
    panel = spark.read.parquet(f"{base}/gold/annual_panel").filter("ano = 2021")
    assert panel.first().selic_media == 100.0


def test_the_same_files_again_rewrite_no_partition(spark, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "lake")
    land(raw, "bcb_selic", series("bcb", "selic_mensal", (2019, 2020)))

    def files():
        folder = medallion.silver_path(base)
        return {(d, n, os.stat(os.path.join(d, n)).st_mtime_ns) for d, _, names in os.walk(folder) for n in names}

    medallion.run(spark, str(raw), base)
    before = files()
    medallion.run(spark, str(raw), base)
    assert files() == before


def test_a_run_without_any_source_fails(spark, tmp_path):
    with pytest.raises(ValueError):
        medallion.run(spark, str(tmp_path), str(tmp_path / "lake"))
