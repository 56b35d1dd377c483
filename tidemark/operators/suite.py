"""Running many checks into one report."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions._columns import as_predicate

ANY_FAILURE = "!= 0"


def surplus_weight() -> Column:
    """Failures of ``equality``: rows found, plus how far the two sides are out of balance."""
    side = F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1)
    return F.count(F.lit(1)) + F.coalesce(F.abs(F.sum(side)), F.lit(0))


def sum_weight(column: str) -> Column:
    """Failures of the row-count checks: the sum of ``column``."""
    return F.coalesce(F.sum(column), F.lit(0))


@dataclass(frozen=True)
class Thresholds:
    """When failures warn or fail: comparisons such as ``!= 0``, ``> 10`` or ``< 1``."""

    severity: str = "error"
    warn_if: str = ANY_FAILURE
    error_if: str = ANY_FAILURE

    def __post_init__(self):
        if self.severity not in ("error", "warn"):
            raise ValueError(f"severity must be 'error' or 'warn', got {self.severity!r}")
        for condition in (self.warn_if, self.error_if):
            if not re.fullmatch(r"\s*(=|!=|<>|<|<=|>|>=)\s*-?\d+\s*", condition):
                raise ValueError(f"not a threshold: {condition!r}")

    def status(self, failures: Column) -> Column:
        def meets(condition: str) -> Column:
            operator, bound = re.fullmatch(r"\s*([=!<>]+)\s*(-?\d+)\s*", condition).groups()
            bound = F.lit(int(bound))
            return {
                "=": failures == bound,
                "!=": failures != bound,
                "<>": failures != bound,
                "<": failures < bound,
                "<=": failures <= bound,
                ">": failures > bound,
                ">=": failures >= bound,
            }[operator]

        warned = F.when(meets(self.warn_if), "warn").otherwise("pass")
        return F.when(meets(self.error_if), "fail").otherwise(warned) if self.severity == "error" else warned


@dataclass(frozen=True)
class Check:
    """A name for the failing rows of a check; ``weight`` is an aggregate, by default the row count."""

    name: str
    failing: DataFrame
    weight: Column | None = None
    thresholds: Thresholds = Thresholds()


@dataclass(frozen=True)
class RowCheck:
    """A predicate that is true for a failing row, optionally within ``where``; ``table`` names the rows in a mixed suite."""

    name: str
    failing: Column
    where: str | Column | None = None
    thresholds: Thresholds = Thresholds()
    table: DataFrame | None = None


def _report(df: DataFrame, name: str, failures: Column, thresholds: Thresholds) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        failures.cast("bigint").alias("failures"),
        thresholds.status(failures).alias("status"),
    )


def run_suite(checks) -> DataFrame:
    """One report row (check_name, failures, status) per check.

    A suite may also hold ``RowCheck`` entries with a table; those of one table share a scan.
    """
    reports, by_table = [], {}
    for check in checks:
        if isinstance(check, RowCheck):
            by_table.setdefault(id(check.table), []).append(check)
            continue
        weight = F.count(F.lit(1)) if check.weight is None else check.weight
        total = check.failing.agg(weight.alias("__failures"))
        reports.append(_report(total, check.name, F.col("__failures"), check.thresholds))
    reports += [run_row_checks(group[0].table, group) for group in by_table.values()]
    if not reports:
        raise ValueError("there are no checks to run")
    return reduce(DataFrame.unionAll, reports)


def run_row_checks(df: DataFrame, checks) -> DataFrame:
    """The same report for any number of row checks on one table, from a single scan."""
    checks = list(checks)
    if not checks:
        raise ValueError("there are no checks to run")
    counts = []
    for i, check in enumerate(checks):
        failing = check.failing if check.where is None else as_predicate(check.where) & check.failing
        counts.append(F.count_if(failing).alias(f"__{i}"))
    totals = df.agg(*counts)
    lines = [
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.col(f"__{i}").alias("failures"),
            check.thresholds.status(F.col(f"__{i}")).alias("status"),
        )
        for i, check in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*lines)))
