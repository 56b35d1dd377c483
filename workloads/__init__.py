"""The registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

from workloads.registry import ORACLES, QUERIES

for _module in ("series", "landing", "updates", "shapes", "scalars", "quality"):
    importlib.import_module(f"workloads.{_module}")

__all__ = ["ORACLES", "QUERIES"]
