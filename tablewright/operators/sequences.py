"""Stored sequences: new keys for old ones, by scope, for many runs at once.

A run first claims a block of numbers in each of its scopes. Claims are rows of a small table that only ever grows; its versions follow
one another by files that are made only where there is none, so of two runs that ask at once one asks again. Then the run numbers its
keys inside its blocks and adds them to the stored mapping. A run that stops in between leaves a gap, never a number twice, and what
was stored before is not written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.keys import match, positions
from tablewright.operators.versions import VersionChanged, current_version, entries, open_table, open_version, show, stage
from tablewright.session import scratch_path


def _scope_key(scope: Sequence[str]) -> Column:
    """A text for the scope columns of a row; nulls are values of their own."""
    return F.to_json(F.struct(*scope), {"ignoreNullFields": "false"}) if scope else F.lit("")


def claim(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Reserve ``n`` places for each ``scope_key``; ``taken`` is how many were reserved before, by whoever."""
    while True:
        version = current_version(spark, path)
        before = wanted.withColumn("taken", F.lit(0).cast("bigint"))
        if version is not None:
            sums = open_table(spark, path).groupBy("scope_key").agg(F.sum("n").alias("taken"))
            before = wanted.join(sums, "scope_key", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))
        folder, _ = stage(before.select("scope_key", F.col("n").cast("bigint").alias("n"), "taken"), path)
        try:
            show(spark, path, [*entries(version), folder], version)
        except VersionChanged:
            continue
        return open_version(spark, path, [folder])


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "sequence")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extend_sequence(
    spark: SparkSession, path: str, frames: Sequence[tuple[DataFrame, str]], scope: Sequence[str] = (), start: int = 1, step: int = 1,
) -> DataFrame:
    """The stored mapping after every old key of the given columns has a number in its scope.

    Columns: the scope columns, ``source_value`` and ``target_value``. Numbers run from ``start`` by ``step`` in each scope; new keys
    follow in their order, in whatever run they come. A key that another run has stored meanwhile keeps that run's number.
    """
    keys = None
    for df, column in frames:
        part = df.select(*scope, F.col(column).alias("source_value")).where("source_value IS NOT NULL")
        keys = part if keys is None else keys.unionByName(part)
    keys = keys.distinct()
    claims = f"{path}/claims"
    while True:
        version = current_version(spark, path)
        known = open_table(spark, path) if version is not None else None
        fresh = keys if known is None else match(keys, known.select(*scope, "source_value"), [*scope, "source_value"], "left_anti")
        placed = _stored(positions(fresh.withColumn("scope_key", _scope_key(scope)), ["scope_key"], ["source_value"], "place"))
        if known is not None and placed.isEmpty():
            return known
        if known is not None and current_version(spark, claims) is None:  # a mapping that was stored without claims
            last = F.max((F.col("target_value") - F.lit(start)) / F.lit(step)).cast("bigint") + 1
            claim(spark, claims, known.groupBy(_scope_key(scope).alias("scope_key")).agg(last.alias("n")))
        blocks = claim(spark, claims, placed.groupBy("scope_key").agg(F.count("*").alias("n")))
        number = F.lit(start).cast("bigint") + (F.col("taken") + F.col("place")) * F.lit(step)
        rows = placed.join(blocks.select("scope_key", "taken"), "scope_key").select(*scope, "source_value", number.alias("target_value"))
        folder, _ = stage(rows, path)
        try:
            show(spark, path, [*entries(version), folder], version)
        except VersionChanged:
            continue
        return open_table(spark, path)
