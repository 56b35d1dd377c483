"""Payloads to landing files, bronze, observations, marts and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.text import TREND_LABELS
from tidemark.operators import checks
from tidemark.operators.suite import Check, RowCheck, run_suite
from tidemark.plans.incremental import update_marts, update_observations
from tidemark.plans.silver import silver
from tidemark.sources.candidates import land_sources
from tidemark.sources.landing import append_bronze, gated_files, load_if_present, read_series_csv, stamp
from tidemark.sources.schemas import CATEGORIES, select_sources
from tidemark.sources.tables import export_parquet, load, register_view, table_exists

MARTS = ("annual_panel", "monthly_series", "lagged_comparison")


def silver_path(base_dir: str) -> str:
    return f"{base_dir}/silver/observations"


def ingest_bronze(spark: SparkSession, raw_dir: str, base_dir: str, names=None) -> dict[str, int]:
    """Append the landing files of sources that pass the row gate; rows written per source."""
    sources = select_sources(names)
    records = gated_files(spark, raw_dir, sorted({source.agency for source in sources}))
    written = {}
    for source in sources:
        if records.get(f"{source.name}.csv"):
            landed = read_series_csv(spark, f"{raw_dir}/{source.name}.csv", source.schema)
            written[source.name] = append_bronze(stamp(landed, source.name), f"{base_dir}/bronze/{source.group}")
    return written


def build_silver(spark: SparkSession, base_dir: str, **options) -> DataFrame:
    """Observations recomputed from the whole bronze history."""
    tables = {category: load_if_present(spark, f"{base_dir}/bronze/{group}") for group, category in CATEGORIES.items()}
    return silver({category: df for category, df in tables.items() if df is not None}, **options)


def mart_checks(marts: dict[str, DataFrame]) -> DataFrame:
    """The report of the checks declared for the marts."""
    panel, monthly, lagged = (marts[name] for name in MARTS)
    return run_suite(
        [
            RowCheck("panel_year_not_null", checks.is_missing("ano"), table=panel),
            Check("panel_year_unique", checks.unique(panel, "ano")),
            RowCheck("monthly_indicator_not_null", checks.is_missing("indicador"), table=monthly),
            RowCheck("monthly_value_not_null", checks.is_missing("valor"), table=monthly),
            Check("monthly_trend_accepted", checks.accepted_values(monthly, "tendencia", TREND_LABELS)),
            RowCheck("lagged_year_not_null", checks.is_missing("ano"), table=lagged),
            Check("lagged_year_unique", checks.unique(lagged, "ano")),
        ]
    )


def run(spark: SparkSession, raw_dir: str, base_dir: str, names=None, payload_dir: str | None = None, view: str = "observations") -> DataFrame:
    """Every stage in order; returns the check report. With ``payload_dir`` the landing files are first made from payloads.

    Observations and marts are brought up to date from the bronze files that no earlier run has read; the result is that of a full recomputation.
    """
    if payload_dir:
        land_sources(spark, payload_dir, raw_dir, names)
    ingest_bronze(spark, raw_dir, base_dir, names)
    tables = {f"{base_dir}/bronze/{group}": category for group, category in CATEGORIES.items()}
    changes = update_observations(spark, base_dir, tables, silver_path(base_dir))
    if not table_exists(spark, silver_path(base_dir)):
        raise ValueError("no landing table has rows")
    observations, exported = load(spark, silver_path(base_dir)), f"{base_dir}/parquet/{view}"
    if changes is not None or not table_exists(spark, exported):
        export_parquet(observations, exported)
    register_view(spark, view, exported)
    return mart_checks(update_marts(spark, base_dir, observations, changes))
