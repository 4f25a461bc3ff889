"""Profiles of published tables that are kept and merged: rows that were added are measured, rows that were there are not read again.

A state is kept for each folder or file that a version lists: rows, values, smallest and largest value in their own types, and a
sketch of the distinct values of every column. States of the entries at hand are merged when the profile is read. A change by
file replaces entries, so only what it has written is measured anew.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.records import long_form, named, quoted
from tablewright.operators.versions import current_version, entries, file_numbers, open_table, open_version, show_more, stage

#: log2 of a sketch's registers: 4096 of them estimate within about 1.6 %.
SKETCH = 12


def _ordered(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType, T.BinaryType))


def _hashed(column: str, kind: T.DataType) -> Column:
    """What a sketch counts: a hash of the value, as sketches take numbers only; null is no value."""
    value = F.to_json(F.struct(named(column))) if isinstance(kind, (T.MapType, T.VariantType)) else F.col(named(column))
    return F.when(F.col(named(column)).isNotNull(), F.xxhash64(value))


def _states(df: DataFrame, file: Column) -> DataFrame:
    """One row per file, with the measures of all columns side by side; one pass."""
    aggs = [F.count("*").alias("n")]
    for i, f in enumerate(df.schema.fields):
        aggs.append(F.count(F.col(named(f.name))).alias(f"c{i}"))
        aggs.append(F.hll_sketch_agg(_hashed(f.name, f.dataType), SKETCH).alias(f"d{i}"))
        if _ordered(f.dataType):
            aggs += [F.min(named(f.name)).alias(f"lo{i}"), F.max(named(f.name)).alias(f"hi{i}")]
    return df.withColumn("__file", file).groupBy(F.col("__file").alias("file")).agg(*aggs)


def _merged(states: DataFrame) -> DataFrame:
    """States of files as those of the entries they belong to; the only state of an entry without rows is a blank one."""
    merge = {"n": F.sum, "c": F.sum, "d": lambda c: F.when(F.sum("n") > 0, F.hll_union_agg(c)), "lo": F.min, "hi": F.max}
    aggs = [merge[c.rstrip("0123456789")](c).alias(c) for c in states.columns if c != "entry"]
    return states.groupBy("entry").agg(*aggs)


def update_profile(spark: SparkSession, path: str, store: str) -> int:
    """Measure the entries of a published table that have no state yet; how many they were comes back.

    Two runs at once may both measure an entry; their states are equal, and one of them is used.
    """
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing published at {path}")
    listed = entries(version)
    schema = open_table(spark, path).schema
    kept = f"{store}/{_shape(schema)}"
    known = set()
    if current_version(spark, kept) is not None:
        known = {r["entry"] for r in open_table(spark, kept).select("entry").distinct().collect()}  # as many as the table lists
    new = [n for n in listed if n not in known]
    if new:
        number, listed = file_numbers(spark, path, new)
        found = _states(open_version(spark, path, new, schema), number)
        single = set(new)
        owners = spark.createDataFrame(
            [(k, f if f in single else f.split("/")[0]) for k, f in listed.items()], T.StructType([found.schema["file"], T.StructField("entry", T.StringType())]))
        blank = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "n" else F.lit(0).cast("bigint").alias("n") for f in found.schema.fields[1:]]
        empty = spark.createDataFrame([(n,) for n in new], "entry string").select("entry", *blank)
        folder, _ = stage(_merged(owners.join(found, "file").drop("file").unionByName(empty)).coalesce(1), kept)
        show_more(spark, kept, folder)
    return len(new)


def _shape(schema: T.StructType) -> str:
    """States of other columns are kept apart."""
    return hashlib.md5(schema.simpleString().encode()).hexdigest()


def read_profile(spark: SparkSession, path: str, store: str, table: str) -> DataFrame:
    """Rows, nulls, estimated distinct values, smallest and largest value (as text) of every column, from the stored states.

    Brings the states up to date first. Columns without an order have no smallest and largest value.
    """
    update_profile(spark, path, store)
    schema = open_table(spark, path).schema
    listed = spark.createDataFrame([(n,) for n in entries(current_version(spark, path))], "entry string")
    states = open_table(spark, f"{store}/{_shape(schema)}").dropDuplicates(["entry"]).join(listed, "entry", "left_semi")
    # A sketch that has met another one estimates by its registers alone. Each state is taken twice, so that this
    # holds for a single one as well: the estimate depends on the values, not on the number of entries.
    both = states.unionByName(states)
    aggs, records = [(F.sum("n") / 2).cast("bigint").alias("n")], []
    for i, f in enumerate(schema.fields):
        aggs.append(F.coalesce((F.sum(f"c{i}") / 2).cast("bigint"), F.lit(0)).alias(f"c{i}"))
        aggs.append(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")), F.lit(0)).cast("bigint").alias(f"d{i}"))
        ordered = _ordered(f.dataType)
        if ordered:
            aggs += [F.min(f"lo{i}").cast("string").alias(f"lo{i}"), F.max(f"hi{i}").cast("string").alias(f"hi{i}")]
        none = "cast(NULL AS STRING)"
        records.append({
            "table_name": quoted(table), "column_name": quoted(f.name), "row_count": "n", "null_count": f"n - c{i}",
            "min_value": f"lo{i}" if ordered else none, "max_value": f"hi{i}" if ordered else none, "distinct_count": f"d{i}",
        })
    return long_form(both.agg(*aggs), records)
