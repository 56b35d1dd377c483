"""Observations and marts brought up to date from what is new, with the result of a full recomputation.

Bronze tables only grow, so a ledger of the files that were read tells what is new. New rows go into a table of newest rows (one per key, with
the load they came from); the keys whose values change there name the seasons (groups of the yearly change) that are computed again, from the few
parts of that table that hold them. Observations that come out different go into the observation table, and their old and new values into the
marts: sums and counts per year and indicator are added to and subtracted from, and a minimum or maximum is looked up again only
where the row that held it has changed.

A run that breaks off loses nothing: the seasons to be computed are written down before the newest rows change, files enter the ledger at the end,
and marts whose update did not finish are built anew from the observations.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.maths import round_scaled
from tidemark.operators.reshape import pivot_fixed
from tidemark.plans.marts import (
    COMPARISON_COLUMNS,
    COMPARISON_MEANS,
    PANEL_COLUMNS,
    PANEL_FIRST_YEAR,
    comparison_of,
    month_rows,
    monthly_series,
)
from tidemark.plans.silver import LOAD_COLUMNS, OBSERVATION_COLUMNS, OBSERVATION_KEY, YOY_KEYS, harmonise, newest_observations, union_series, yoy
from tidemark.session import materialise, remove_path
from tidemark.sources.evolution import parts, read_parts
from tidemark.sources.landing import path_exists
from tidemark.sources.summaries import folder_of_row, partition_files
from tidemark.sources.tables import apply_changes, find_changes, load, publish, table_exists, write_partitioned

BUCKET = "__bucket"
# Parts of the table of newest rows; a season lies in one of them.
BUCKETS = 16
# Holds 26 digits before the point; sums in it do not depend on the order of addition, and subtracting undoes adding.
EXACT = "decimal(38,12)"
PARTITION_COLUMNS = ["fonte", "ano"]


# --- what is new ---


def _ledger(base_dir: str) -> str:
    return f"{base_dir}/silver/ledger"


def new_files(spark: SparkSession, path: str, base_dir: str) -> dict[str, list[str]]:
    """The files of a bronze table that no finished run has read, by the part of the table they lie in."""
    read = set()
    if path_exists(spark, f"{_ledger(base_dir)}/_SUCCESS"):
        # The driver holds the list of files in any case.
        read = {row.file for row in spark.read.parquet(_ledger(base_dir)).select("file").collect()}
    found = {}
    for part in parts(spark, path):
        listed = {f"{folder}/{name}" for folder, names in partition_files(spark, part).items() for name in names}
        found[part] = sorted(listed - read)
    return found


def new_rows(spark: SparkSession, path: str, files: Mapping[str, list[str]]) -> DataFrame | None:
    """The rows of some files of a bronze table, or None without any."""
    rows = read_parts(spark, path, files) if any(files.values()) else None
    return None if rows is None or rows.isEmpty() else rows


# --- observations ---


def _newest(base_dir: str) -> str:
    return f"{base_dir}/silver/newest"


def _pending(base_dir: str) -> str:
    return f"{base_dir}/silver/pending"


def _same(left: str, right: str, names) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names])


def changed_seasons(changes: DataFrame) -> DataFrame:
    """The seasons that lose, gain or restate an observation, each with its part of the table of newest rows."""
    now, before = (F.struct(*[column(name).alias(name) for name in OBSERVATION_COLUMNS]) for column in (F.col, lambda name: F.col("__old")[name]))
    other = changes.filter(F.col("__old").isNull() | ~now.eqNullSafe(before))
    places = [*YOY_KEYS, BUCKET]
    left = other.filter("__old IS NOT NULL").select(*[F.col("__old")[name].alias(name) for name in places])
    return other.select(*places).unionByName(left).distinct()


def _bucketed(observations: DataFrame, buckets: int) -> DataFrame:
    return observations.withColumn(BUCKET, F.pmod(F.xxhash64(*YOY_KEYS), F.lit(buckets)).cast("int"))


def update_newest(spark: SparkSession, base_dir: str, incoming: DataFrame, buckets: int = BUCKETS) -> DataFrame | None:
    """Take new landing rows into the table of newest rows; the seasons to compute again, also those of a run that broke off, or None."""
    path, keys = _newest(base_dir), [OBSERVATION_KEY]
    # The order in which ``newest_observations`` prefers rows.
    preferred = [*LOAD_COLUMNS, *[name for name in OBSERVATION_COLUMNS if name != OBSERVATION_KEY]]
    rows = _bucketed(newest_observations(incoming), buckets)
    changes = find_changes(spark, path, rows, keys, [BUCKET], newer_by=preferred, keep=OBSERVATION_COLUMNS, unique=True)
    seasons = changed_seasons(changes)
    seasons.write.mode("append").parquet(_pending(base_dir))
    apply_changes(spark, path, changes, keys, [BUCKET])
    return waiting_seasons(spark, base_dir)


def waiting_seasons(spark: SparkSession, base_dir: str) -> DataFrame | None:
    """Seasons that a run has written down and not finished."""
    if not path_exists(spark, f"{_pending(base_dir)}/_SUCCESS"):
        return None
    seasons = spark.read.parquet(_pending(base_dir)).distinct()
    return None if seasons.isEmpty() else seasons


def season_observations(spark: SparkSession, base_dir: str, seasons: DataFrame, strict: bool = False, split: bool = True, built_at=None) -> DataFrame:
    """The observations of some seasons, with their yearly change. Only the parts that hold them are read."""
    parts = sorted(row[BUCKET] for row in seasons.select(BUCKET).distinct().collect())  # at most the number of parts
    stored = load(spark, _newest(base_dir)).filter(F.col(BUCKET).isin(*parts))
    members = stored.alias("stored").join(seasons.alias("season"), _same("stored", "season", YOY_KEYS), "left_semi")
    moment = F.current_timestamp() if built_at is None else F.lit(built_at).cast("timestamp")
    return yoy(members.select(*OBSERVATION_COLUMNS), strict=strict, split=split).withColumn("_silver_at", moment)


def update_observations(spark: SparkSession, base_dir: str, tables: dict[str, str], observations_path: str, **options) -> DataFrame | None:
    """Bring the observation table up to date with the bronze tables (path to category); what changed, or None.

    The result has the rows as stored, and in ``__old`` the indicator, year, month and value before (null for new observations). Options: ``strict``,
    ``split`` and ``built_at`` as for ``silver``; a table keeps the ``strict`` that it was begun with.
    """
    files = {path: new_files(spark, path, base_dir) for path in tables}
    found = {path: new_rows(spark, path, names) for path, names in files.items()}
    frames = [harmonise(rows, tables[path]) for path, rows in found.items() if rows is not None]
    seasons = update_newest(spark, base_dir, union_series(frames)) if frames else waiting_seasons(spark, base_dir)
    changes = None
    if seasons is not None:
        rows = season_observations(spark, base_dir, seasons, **options)
        keep = ["indicador", "mes", "valor"]
        options = {"ignore": ["_silver_at"], "keep": keep, "unique": True}  # of unique rows, whole seasons
        changes = find_changes(spark, observations_path, rows, [OBSERVATION_KEY], PARTITION_COLUMNS, **options)
        mark_marts(spark, base_dir)
        apply_changes(spark, observations_path, changes, [OBSERVATION_KEY], PARTITION_COLUMNS)
    remove_path(spark, _pending(base_dir))
    read = [(name,) for by_part in files.values() for names in by_part.values() for name in names]
    if read:
        spark.createDataFrame(read, "file string").coalesce(1).write.mode("append").parquet(_ledger(base_dir))
    return changes


# --- marts ---


def gold_path(base_dir: str, name: str) -> str:
    return f"{base_dir}/gold/{name}"


def _mark(base_dir: str) -> str:
    return f"{base_dir}/gold/unfinished"


def mark_marts(spark: SparkSession, base_dir: str) -> None:
    """Note that the observations are about to change; until the marts have followed, they are to be built anew.

    Each run leaves a mark of its own, so that the next one sees whether another broke off.
    """
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{_mark(base_dir)}/{uuid.uuid4().hex}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark).close()


def _marks(spark: SparkSession, base_dir: str) -> int:
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{_mark(base_dir)}/*")
    return len(marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or ())


def summary_states(observations: DataFrame) -> DataFrame:
    """(ano, indicador, total, n, low, high): sums that can be added to and subtracted from. Values are finite and below 10^26."""
    return observations.filter("valor IS NOT NULL").groupBy("ano", "indicador").agg(*_states(F.col("valor")))


def _states(value: Column) -> list[Column]:
    return [
        F.sum(value.cast(EXACT)).cast(EXACT).alias("total"),
        F.count(value).alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    ]


def annual_panel_of(states: DataFrame, columns=PANEL_COLUMNS, since: int = PANEL_FIRST_YEAR) -> DataFrame:
    """The yearly panel from states, as ``annual_panel`` makes it from observations."""
    mean = round_scaled(F.col("total").cast("double") / F.col("n"), 4)
    return pivot_fixed(states.filter(F.col("ano") >= since).withColumn("valor_medio", mean), ["ano"], "indicador", "valor_medio", columns)


def value_changes(changes: DataFrame) -> DataFrame:
    """(ano, mes, indicador, valor, sign): +1 for each value that the observation table gained, -1 for each that it lost."""
    names = ["ano", "mes", "indicador", "valor"]
    gained = changes.select(*names, F.lit(1).alias("sign"))
    lost = changes.filter("__old IS NOT NULL").select(*[F.col("__old")[name].alias(name) for name in names], F.lit(-1).alias("sign"))
    return gained.unionByName(lost).filter("valor IS NOT NULL")


def _in_years(years) -> Column:
    """Whether a row is of one of some years, the missing year included if it is listed."""
    known = F.col("ano").isin(*[year for year in years if year is not None])
    return known | F.col("ano").isNull() if None in years else known


def merged_states(states: DataFrame, deltas: DataFrame, observations: DataFrame) -> DataFrame:
    """``states`` after the value changes ``deltas``, written aside. ``observations``, as they are now, are read only for the years and indicators that lost their
    smallest or largest value."""
    gained, signed = F.col("sign") > 0, F.col("valor").cast(EXACT) * F.col("sign")
    moved = deltas.groupBy("ano", "indicador").agg(
        F.sum(signed).cast(EXACT).alias("total"),
        F.sum("sign").alias("n"),
        F.min(F.when(gained, F.col("valor"))).alias("low"),
        F.max(F.when(gained, F.col("valor"))).alias("high"),
        F.min(F.when(~gained, F.col("valor"))).alias("lost_low"),
        F.max(F.when(~gained, F.col("valor"))).alias("lost_high"),
    )
    joined = states.alias("state").join(moved.alias("moved"), _same("state", "moved", ["ano", "indicador"]), "full_outer")
    either = [F.coalesce(F.col(f"state.{name}"), F.col(f"moved.{name}")).alias(name) for name in ("ano", "indicador")]
    zero = F.lit(0)
    lost_end = (F.col("moved.lost_low") <= F.col("state.low")) | (F.col("moved.lost_high") >= F.col("state.high"))
    merged = joined.select(
        *either,
        (F.coalesce("state.total", zero) + F.coalesce("moved.total", zero)).cast(EXACT).alias("total"),
        (F.coalesce("state.n", zero) + F.coalesce("moved.n", zero)).alias("n"),
        F.least("state.low", "moved.low").alias("low"),
        F.greatest("state.high", "moved.high").alias("high"),
        F.coalesce(lost_end, F.lit(False)).alias("again"),
    )
    merged = materialise(merged.filter("n > 0"), "states")
    again = merged.filter("again").select("ano", "indicador")
    years = [row.ano for row in again.select("ano").distinct().collect()]  # years
    if not years:
        return merged.drop("again")
    touched = observations.filter(_in_years(years)).filter("valor IS NOT NULL")
    held = touched.alias("stored").join(F.broadcast(again).alias("again"), _same("stored", "again", ["ano", "indicador"]), "left_semi")
    ends = held.groupBy("ano", "indicador").agg(F.min("valor").alias("low"), F.max("valor").alias("high"))
    kept = merged.filter("NOT again").drop("again")
    found = merged.filter("again").drop("low", "high").alias("state").join(ends.alias("ends"), _same("state", "ends", ["ano", "indicador"]))
    return kept.unionByName(found.select("state.ano", "state.indicador", "total", "n", "low", "high"))


def merged_months(months: DataFrame, deltas: DataFrame, observations: DataFrame, compared: Mapping[str, str] = COMPARISON_COLUMNS) -> DataFrame:
    """``months`` after the value changes ``deltas``, written aside: the touched months are computed again from the touched years."""
    touched = materialise(deltas.filter("mes IS NOT NULL").select("ano", "mes").distinct(), "months")  # calendar months
    years = [row.ano for row in touched.select("ano").distinct().collect()]
    if not years:
        return materialise(months, "months")
    same = _same("stored", "touched", ["ano", "mes"])
    again = observations.filter(_in_years(years)).alias("stored").join(F.broadcast(touched).alias("touched"), same, "left_semi")
    kept = months.alias("stored").join(F.broadcast(touched).alias("touched"), same, "left_anti")
    return materialise(kept.unionByName(month_rows(again, compared)), "months")


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return load(df.sparkSession, path)


def _replace_years(rows: DataFrame, path: str, years: set) -> None:
    """Rewrite some years of a table that is partitioned by year; years without rows go."""
    spark, rows = rows.sparkSession, materialise(rows, "years")
    held = {row.ano for row in rows.select("ano").distinct().collect()}
    stale = load(spark, path).filter(_in_years(years - held)) if years - held else None
    folders = [] if stale is None else [row.folder for row in stale.select(folder_of_row().alias("folder")).distinct().collect()]
    publish(rows, path, ["ano"])
    for folder in folders:
        remove_path(spark, folder)


def update_marts(
    spark: SparkSession,
    base_dir: str,
    observations: DataFrame,
    changes: DataFrame | None,
    panel: Mapping[str, str] = PANEL_COLUMNS,
    since: int = PANEL_FIRST_YEAR,
    compared: Mapping[str, str] = COMPARISON_COLUMNS,
    means: Mapping[str, str] = COMPARISON_MEANS,
) -> dict[str, DataFrame]:
    """Bring the marts up to date: by the changes if the marts had followed all earlier ones, else from all observations.

    ``panel``, ``since``, ``compared`` and ``means`` as for ``annual_panel`` and ``lagged_comparison``; marts keep those that they were begun with.
    """
    names = ("annual_panel", "monthly_series", "lagged_comparison")
    stored = {name: gold_path(base_dir, name) for name in (*names, "panel_states", "month_states")}
    complete = all(table_exists(spark, path) for path in stored.values())
    marks = _marks(spark, base_dir)
    follows = complete and marks <= (0 if changes is None else 1)
    if follows and (changes is None or changes.isEmpty()):
        remove_path(spark, _mark(base_dir))
        return {name: load(spark, stored[name]) for name in names}
    if follows:
        deltas = materialise(value_changes(changes), "deltas")
        states = merged_states(load(spark, stored["panel_states"]), deltas, observations)
        months = merged_months(load(spark, stored["month_states"]), deltas, observations, compared)
        before = changes.filter("__old IS NOT NULL").select("__old.ano")
        years = {row.ano for row in changes.select("ano").union(before).distinct().collect()}
        _replace_years(monthly_series(observations.filter(_in_years(years))), stored["monthly_series"], years)
    else:
        states, months = summary_states(observations), month_rows(observations, compared)
        write_partitioned(monthly_series(observations), stored["monthly_series"], ["ano"])
    states, months = _store(states, stored["panel_states"]), _store(months, stored["month_states"])
    _store(annual_panel_of(states, panel, since), stored["annual_panel"])
    _store(comparison_of(months, means), stored["lagged_comparison"])
    remove_path(spark, _mark(base_dir))
    return {name: load(spark, stored[name]) for name in names}
