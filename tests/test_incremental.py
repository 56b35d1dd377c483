"""Incremental observations and marts against a full recomputation."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental
from tidemark.plans.marts import annual_panel, lagged_comparison, monthly_series
from tidemark.plans.silver import OBSERVATION_COLUMNS, silver
from tidemark.sources.landing import append_bronze, load_if_present, stamp
from tidemark.sources.tables import load

MONTHLY = "fonte string, indicador string, data string, ano int, mes int, valor double, unidade string, dt_carga string"
QUARTERLY = "fonte string, indicador string, periodo string, ano int, trimestre int, valor double, unidade string, dt_carga string"
NAMES = ("selic_mensal", "ipca_mensal", "cambio_usd_brl")
COLUMNS = [*OBSERVATION_COLUMNS, "variacao_yoy"]


class Lake:
    """Bronze tables that grow load by load, and what is made from them."""

    def __init__(self, spark, base):
        self.spark, self.base, self.loads = spark, str(base), 0
        self.tables = {f"{base}/bronze/series": "monetario", f"{base}/bronze/pib": "atividade"}
        self.observations = f"{base}/silver/observations"

    def land(self, *rows, quarterly=False, loaded_at=None):
        self.loads += 1
        path = list(self.tables)[quarterly]
        frame = self.spark.createDataFrame(list(rows), QUARTERLY if quarterly else MONTHLY)
        append_bronze(stamp(frame, "test", loaded_at or f"2024-01-{self.loads:02d} 00:00:00"), path)

    def update(self):
        changes = incremental.update_observations(self.spark, self.base, self.tables, self.observations)
        return incremental.update_marts(self.spark, self.base, load(self.spark, self.observations), changes)

    def check(self):
        frames = {category: load_if_present(self.spark, path) for path, category in self.tables.items()}
        whole = silver({category: df for category, df in frames.items() if df is not None})
        stored = load(self.spark, self.observations)
        assert listed(stored, COLUMNS) == listed(whole, COLUMNS)
        for name, mart in (("annual_panel", annual_panel), ("monthly_series", monthly_series), ("lagged_comparison", lagged_comparison)):
            wanted = mart(whole)
            assert listed(load(self.spark, incremental.gold_path(self.base, name)), wanted.columns) == listed(wanted, wanted.columns), name

    def files(self, folder):
        return {(d[len(self.base) :], n) for d, _, names in os.walk(f"{self.base}/{folder}") for n in names if n.endswith(".parquet") and "_key" not in d}


def listed(df, columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


def month(name, year, number, value, carga="2024"):
    return ("bcb", name, f"{year}-{number:02d}-01", year, number, value, "%", carga)


def history(years=range(2018, 2021), months=range(1, 13)):
    return [month(name, y, m, (y % 7) * 1.25 + m * (i + 1) / 8) for i, name in enumerate(NAMES) for y in years for m in months]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, tmp_path / "lake")
    lake.land(*history())
    lake.land(*[("ibge", "pib_variacao_pct", f"{y}-T{q}", y, q, y / 100 + q, "%", "2024") for y in (2018, 2019) for q in (1, 2, 3, 4)], quarterly=True)
    lake.update()
    return lake


def test_loads_of_all_kinds(lake):
    lake.check()
    lake.land(month(NAMES[0], 2019, 3, 99.0))  # restated, the largest of its year
    lake.update()
    lake.check()
    lake.land(month(NAMES[0], 2019, 3, 1.0), month(NAMES[1], 2017, 5, -4.0), month("new", 2021, 1, 3.0))  # no longer; before all; a new series
    lake.update()
    lake.check()
    lake.land(*history())  # everything again, with a newer load: restated values fall back
    lake.update()
    lake.check()


def test_old_and_equal_loads(lake):
    lake.land(month(NAMES[2], 2020, 7, 5.0), loaded_at="2020-01-01 00:00:00")  # older than what is there
    lake.update()
    lake.check()
    lake.land(month(NAMES[2], 2020, 7, 6.0), month(NAMES[2], 2020, 7, 7.0), month(NAMES[2], 2020, 8, None))  # twice in one load; no value
    lake.update()
    lake.check()


def test_an_observation_moves_to_another_season_and_year(lake):
    moved = list(month(NAMES[1], 2019, 3, 2.5))
    moved[3:5] = [2022, 4]  # the key names March 2019, the columns another month
    lake.land(tuple(moved))
    lake.update()
    lake.check()
    for number in range(1, 13):  # 2018 loses all of its months
        for name in NAMES:
            row = list(month(name, 2018, number, 1.0))
            row[3] = 2030
            lake.land(tuple(row)) if number == 1 else None
    lake.update()
    lake.check()


def test_one_month_touches_one_season(lake):
    newest, observations = lake.files("silver/newest"), lake.files("silver/observations")
    lake.land(month(NAMES[0], 2019, 3, 42.0))
    seen = []
    original = incremental.season_observations

    def counted(spark, base, seasons, **options):
        seen.append(listed(seasons, seasons.columns[:3]))
        return original(spark, base, seasons, **options)

    incremental.season_observations = counted
    try:
        lake.update()
    finally:
        incremental.season_observations = original
    assert seen == [[(NAMES[0], 3, None)]]
    assert len({d for d, _ in newest - lake.files("silver/newest")}) == 1
    # The month itself and its successor a year later.
    assert {d.split("/")[-1] for d, _ in observations - lake.files("silver/observations")} == {"ano=2019", "ano=2020"}
    lake.check()


def test_nothing_new(lake):
    before = lake.files("")
    assert incremental.update_observations(lake.spark, lake.base, lake.tables, lake.observations) is None
    lake.update()
    assert lake.files("") == before


@pytest.mark.parametrize("step", range(3))
def test_a_run_that_breaks_off(lake, monkeypatch, step):
    """Whatever a run has done before it breaks off, the next one ends with the result of a full recomputation."""
    places = [("apply_changes", 0), ("apply_changes", 1), ("_store", 2)]
    name, calls = places[step]
    original, left = getattr(incremental, name), [calls]

    def breaks(*args, **options):
        if not left[0]:
            raise RuntimeError("lost")
        left[0] -= 1
        return original(*args, **options)

    lake.land(month(NAMES[0], 2019, 3, 42.0), month(NAMES[2], 2020, 1, -1.0))
    with monkeypatch.context() as patch:
        patch.setattr(incremental, name, breaks)
        with pytest.raises(RuntimeError):
            lake.update()
    lake.land(month(NAMES[0], 2019, 4, 43.0))
    lake.update()
    lake.check()


def test_states_add_and_subtract(spark):
    """Sums come out the same whatever the order of changes, also where floating-point sums would not."""
    rows = [(2020, 1, "a", value) for value in (0.1, 0.2, 0.3, 1e9, -1e9)] + [(2021, 1, "a", 5.0), (2021, 1, "b", 6.0)]
    table = spark.createDataFrame(rows, "ano int, mes int, indicador string, valor double")
    states = incremental.summary_states(table)
    left = spark.createDataFrame(rows[:3] + rows[6:] + [(2022, 1, "c", 7.0)], table.schema)
    signs = [(*row, -1) for row in rows[3:6]] + [(2022, 1, "c", 7.0, 1)]
    deltas = spark.createDataFrame(signs, "ano int, mes int, indicador string, valor double, sign int")
    merged = incremental.merged_states(states, deltas, left)
    names = ["ano", "indicador", "total", "n", "low", "high"]
    assert listed(merged, names) == listed(incremental.summary_states(left), names)
    assert merged.filter("ano = 2020").select(F.col("total").cast("string")).first()[0] == "0.600000000000"
