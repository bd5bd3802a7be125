"""Queries of the library and their SQL, by operator id."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame, and the SQL that gives the same rows."""

    def keep(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return keep


#: Modules that register queries on import.
MODULES = ["scalars", "joins", "windows", "aggregates", "domain", "forecast", "scenario", "fitted", "sensitivity", "exploration", "quality", "storage", "assertions"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"wattframe.plans.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumption-weighted monthly price with its coverage."""
    _load()
    return QUERIES["dom_19_weighted_price"](spark, sf_dir)
