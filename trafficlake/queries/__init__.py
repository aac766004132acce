"""Operators bound to the driver tables, with the SQL that states their results."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("logs", "scans", "readers", "shapes", "events", "analysis", "builds")


def _modules():
    return [importlib.import_module(f"trafficlake.queries.{name}") for name in MODULES]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _modules() for name, f in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLE.items()}
