"""Tables brought up to date load by load; the SQL recomputes them from all loads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.plans.incremental import update_marts, update_observations
from tidemark.plans.silver import OBSERVATION_COLUMNS
from tidemark.session import scratch_path
from tidemark.sources.landing import append_bronze, stamp
from tidemark.sources.tables import load
from workloads.inputs import FIRST_LOAD, OBSERVATIONS_SQL, SECOND_LOAD, monthly_landing, quarterly_landing, restated, table
from workloads.registry import query
from workloads.series import FIRST_YEAR, LAGGED_SQL, MEANS, MONTHLY, MONTHLY_MART_SQL, PANEL, PANEL_SQL


def _two_loads(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Observations and marts after a load of both series and one that restates the monthly one, each followed by an update."""
    base = scratch_path(spark, "updates")
    monthly, quarterly, observations = f"{base}/bronze/monthly", f"{base}/bronze/quarterly", f"{base}/silver/observations"
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    loads = [
        [(monthly_landing(orders), monthly, FIRST_LOAD), (quarterly_landing(lines), quarterly, FIRST_LOAD)],
        [(restated(orders), monthly, SECOND_LOAD)],
    ]
    marts = {}
    for landed in loads:
        for rows, path, moment in landed:
            append_bronze(stamp(rows, "orders", moment), path)
        changes = update_observations(spark, base, {monthly: "monetario", quarterly: "atividade"}, observations)
        marts = update_marts(spark, base, load(spark, observations), changes, PANEL, FIRST_YEAR, MONTHLY, MEANS)
    return load(spark, observations), marts


@query(f"WITH {OBSERVATIONS_SQL} SELECT * EXCLUDE (previous_ano) FROM observations")
def incremental_observations(spark, sf_dir):
    return _two_loads(spark, sf_dir)[0].select(*OBSERVATION_COLUMNS, "variacao_yoy")


@query(f"WITH {OBSERVATIONS_SQL} {PANEL_SQL}")
def incremental_panel(spark, sf_dir):
    return _two_loads(spark, sf_dir)[1]["annual_panel"]


@query(f"WITH {OBSERVATIONS_SQL} {MONTHLY_MART_SQL}")
def incremental_monthly(spark, sf_dir):
    return _two_loads(spark, sf_dir)[1]["monthly_series"]


@query(f"WITH {OBSERVATIONS_SQL} {LAGGED_SQL}")
def incremental_lagged(spark, sf_dir):
    return _two_loads(spark, sf_dir)[1]["lagged_comparison"]
