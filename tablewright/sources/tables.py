"""Reading tables: columns, filters, limits, parameterised SQL and counts."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_READER = threading.Lock()


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def load_all(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: load(spark, root, name) for name in names}


def load_counted(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table read so that plain row and value counts come from the file footers alone."""
    return read_counted(spark, [f"{root}/{name}.parquet"])


def read_counted(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files read so that plain row and value counts come from their footers alone.

    Only Spark's newer Parquet reader can push such counts down, so it is
    chosen for this one read. Tables with nested columns keep the usual reader. One thread at a time changes the setting
    and puts it back; a read elsewhere in between gets the same rows by the newer reader.
    """
    usual_reader = spark.read.option("recursiveFileLookup", "true")
    table = usual_reader.parquet(*paths)
    if any(isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) for f in table.schema.fields):
        return table
    setting = "spark.sql.sources.useV1SourceList"
    with _READER:
        usual = spark.conf.get(setting)
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        spark.conf.set(setting, ",".join(s for s in usual.split(",") if s != "parquet"))
        try:
            return spark.read.option("recursiveFileLookup", "true").schema(table.schema).parquet(*paths)
        finally:
            spark.conf.set(setting, usual)


def register(spark: SparkSession, root: str, *names: str) -> None:
    """Give tables a temporary name so that SQL text can use them."""
    for name in names:
        load(spark, root, name).createOrReplaceTempView(name)


def read_table(
    spark: SparkSession, root: str, name: str, columns: Sequence[str] = (), where: str = "", limit: int = 0
) -> DataFrame:
    """Rows of one table; no columns means all, no filter means every row."""
    return take(keep_columns(keep_rows(load(spark, root, name), where), columns), limit)


def keep_rows(df: DataFrame, where: str = "") -> DataFrame:
    return df.where(where) if where.strip() else df


def keep_columns(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    return df.select(*columns) if columns else df


def take(df: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows; zero or less means no limit."""
    return df.limit(limit) if limit > 0 else df


def run_sql(spark: SparkSession, text: str, params: Sequence | Mapping | None = None) -> DataFrame:
    """Any Spark SQL with bound ``?`` or ``:name`` values; nothing is spliced into the text."""
    return spark.sql(text, args=params) if params else spark.sql(text)


def run_capped(
    spark: SparkSession, text: str, cap: int = -1, params: Sequence | Mapping | None = None, default_cap: int = 1000
) -> DataFrame:
    """Run any query and hand back at most ``cap`` rows; a negative cap means the default."""
    return run_sql(spark, text.strip().rstrip(";"), params).limit(default_cap if cap < 0 else cap)


def first_value(df: DataFrame) -> DataFrame:
    """One row with the first column of the first row, named ``value``."""
    return df.select(F.col(df.columns[0]).alias("value")).limit(1)


def optional_count(df: DataFrame, name: str, wanted: str) -> DataFrame:
    """The row count, or -1 without reading anything when the flag says ``false``."""
    if wanted.strip().lower() == "false":
        skipped = df.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("row_count"))
        return skipped.select(F.lit(name).alias("table_name"), "row_count")
    return row_counts({name: df})


def counts_with_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value beside the rows of the whole table.

    The total sums the same per-value counts in a scalar subquery, so no rows are joined.
    """
    grouped = df.groupBy(column).agg(F.count("*").alias("n"))
    return grouped.select(column, "n", grouped.agg(F.sum("n")).scalar().alias("total"))


def in_namespace(spark: SparkSession, namespace: str, text: str, **params) -> DataFrame:
    """Run SQL whose tables are written ``IDENTIFIER(:ns || '.table')``."""
    return spark.sql(text, args={"ns": namespace, **params})


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def sample_size(count: Column, percentage: int = 10, smallest: int = 10, largest: int = 1000) -> Column:
    """Whole-number percentage of a row count, held between two bounds."""
    share = F.floor(count * F.lit(percentage) / F.lit(100)).cast("long")
    return (
        F.when(share < smallest, F.lit(smallest))
        .when(share >= largest, F.lit(largest))
        .otherwise(share)
        .cast("long")
    )


def sample(
    df: DataFrame, percentage: int = 10, smallest: int = 10, largest: int = 100, order: Sequence[str] = ()
) -> DataFrame:
    """A bounded sample of a table, repeatable when ``order`` is given.

    The row count comes from file footers, and the sorted form keeps only
    ``largest`` rows per task.
    """
    size = df.agg(sample_size(F.count("*"), percentage, smallest, largest).alias("n")).first()["n"]
    return (df.orderBy(*order) if order else df).limit(size)


def numbered_rows(spark: SparkSession, count: int) -> DataFrame:
    """Rows 0 .. count-1 in the column ``i``, made on the executors."""
    return spark.range(0, count).withColumnRenamed("id", "i")


def explode_field(parents: DataFrame, keys: Sequence[str], field: str) -> DataFrame:
    """Child rows held in an array of records, with the parent's keys."""
    return parents.select(*keys, F.inline(field))


def pick_settings(items: DataFrame, settings: DataFrame, key: str) -> DataFrame:
    """Join each item to its settings row; the row with an empty key is the default.

    Only the default row is read up front. No broadcast is forced: Spark sees
    how small the settings are.
    """
    columns = [c for c in settings.columns if c != key]
    default = settings.where(F.col(key) == "").select(*columns).first()
    fallback = {c: F.lit(default[c] if default else None) for c in columns}
    named = settings.where(F.col(key) != "")
    return items.join(named, key, "left").select(
        *items.columns, *[F.coalesce(F.col(c), fallback[c]).alias(c) for c in columns]
    )
