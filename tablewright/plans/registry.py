"""Named queries over a table folder, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its check, if SQL can state one."""

    def add(make):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = make
        if sql is not None:
            CHECKS[name] = sql
        return make

    return add
