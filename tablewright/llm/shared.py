"""Reading, storing and registering for the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can state it, the SQL that gives the same rows."""

    def add(make):
        QUERIES[name] = make
        if sql is not None:
            CHECKS[name] = sql
        return make

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows, written once below the shared checkpoint folder and read back.

    This cuts the lineage at files that every executor can read, so a lost
    executor costs one task and never a different answer.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(column: str) -> str:
    """The name of a column of any spelling, dots included."""
    return "`" + column.replace("`", "``") + "`"


def unused(df: DataFrame, stem: str) -> str:
    """A name starting with ``stem`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
