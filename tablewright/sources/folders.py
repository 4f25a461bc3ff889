"""The catalog of a folder: what lies in it is listed as a frame, and only tables that have changed are looked into.

Nothing is known beforehand. A listing of the files tells the tables, their sizes and times; file footers tell columns, types and
comments; counts come from footers too, where a table has no nested columns. What was found is stored, a row per table and a row
per field, with a mark of the files it was found in.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.changes import replace_by_keys
from tablewright.operators.versions import current_version, entries, open_table, publish
from tablewright.sources import files
from tablewright.sources.catalog import crawl_table, define
from tablewright.sources.tables import read_counted

TABLE_COLUMNS = (
    "schema_name string, table_name string, table_type string, location string, file_count bigint, bytes bigint, created timestamp, "
    "modified timestamp, row_count bigint, column_count bigint, collation string, ddl string, state string"
)
LISTED = ("table_name", "location", "file_count", "bytes", "created", "modified", "state")
KEYS = ["schema_name", "table_name"]


class Catalog(NamedTuple):
    """A row per table, and a row per field."""

    tables: DataFrame
    fields: DataFrame


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Path, time and size of every data file below a folder; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.load(root).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """One row per table: each file and each subfolder of the folder is one, named without its ending.

    Sizes and times are those of its files. ``state`` changes when a file comes, goes or is written anew.
    """
    base = files.inner_path(spark, root).rstrip("/")
    place = F.element_at(F.split("path", re.escape(f"{base}/"), 2), -1)
    first = F.regexp_extract(place, "^[^/]+", 0)
    mark = F.xxhash64(place, "modified", "bytes").alias("mark")
    return list_files(spark, root).select("*", first.alias("entry"), mark).groupBy("entry").agg(
        F.count("*").alias("file_count"), F.sum("bytes").alias("bytes"), F.min("modified").alias("created"), F.max("modified").alias("modified"),
        F.concat_ws("-", F.count("*").cast("string"), F.bit_xor("mark").cast("string")).alias("state"),
    ).select(
        F.regexp_replace("entry", r"\.parquet$", "").alias("table_name"), F.concat(F.lit(f"{root.rstrip('/')}/"), "entry").alias("location"),
        "file_count", "bytes", "created", "modified", "state",
    )


def read_table_at(spark: SparkSession, location: str) -> DataFrame:
    """A table wherever it lies: its published version, or all its files."""
    version = current_version(spark, location)
    if version is None:
        return read_counted(spark, [location])
    return read_counted(spark, [f"{location}/{name}" for name in entries(version)])


def ddl(schema: T.StructType, schema_name: str, table: str) -> str:
    """The statement that makes an empty table of these columns."""
    def shown(f: T.StructField) -> str:
        comment = (f.metadata or {}).get("comment")
        return f"{f.name} {f.dataType.simpleString().upper()}" + (f" COMMENT '{comment.replace(chr(39), chr(39) * 2)}'" if comment else "")

    return f"CREATE TABLE {schema_name}.{table} ({', '.join(map(shown, schema.fields))}) USING parquet"


def comments(schema: T.StructType, above: str = "") -> dict[str, str]:
    """Column comments by dotted path, through records and arrays."""
    out = {}
    for f in schema.fields:
        path, inner = above + f.name, f.dataType
        if (f.metadata or {}).get("comment"):
            out[path] = f.metadata["comment"]
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            out |= comments(inner, f"{path}.")
    return out


def _look_into(spark: SparkSession, schema_name: str, table: Mapping, df: DataFrame | None = None) -> tuple[list, list]:
    """The row of a table and the rows of its fields; both are as few as it has columns."""
    kind = "BASE TABLE" if df is None else "VIEW"
    df = read_table_at(spark, table["location"]) if df is None else df
    described = comments(df.schema)
    fields = [r.asDict() for r in crawl_table(df, schema_name, table["table_name"], kind).collect()]
    rows = next((r["row_count"] for r in fields if r["top_level"]), 0)
    collations = {getattr(f.dataType, "collation", None) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    collation = ",".join(sorted(c for c in collations if c)) or "UTF8_BINARY"
    own = {"schema_name": schema_name, "table_type": kind, "row_count": rows, "column_count": len(df.schema.fields), "collation": collation}
    text = ddl(df.schema, schema_name, table["table_name"]) if kind != "VIEW" else None
    version = current_version(spark, table["location"]) if kind != "VIEW" else None
    if version is not None:  # files of older versions are no part of the table
        sizes = [size for name in entries(version) for _, size in files.below(spark, f"{table['location']}/{name}")]
        own |= {"file_count": len(sizes), "bytes": sum(sizes)}
    row = {**{c: table.get(c) for c in LISTED}, **own, "ddl": text}
    return [row[c.split()[0]] for c in TABLE_COLUMNS.split(", ")], [{**f, "description": described.get(f["field_path"])} for f in fields]


def crawl_folder(
    spark: SparkSession, root: str, store: str, schema_name: str = "main", views: Mapping[str, tuple[str, str]] | None = None,
    parallel: int = 8, group: int = 500,
) -> Catalog:
    """Bring the stored catalog of a folder up to date and open it.

    Tables whose files are as they were are not looked into; tables that are gone lose their rows. Up to ``parallel`` tables
    are crawled at a time, and their rows are written ``group`` tables at a time, each group's all or none. ``views`` maps a name to
    (table, condition). A table's rows pass the driver: as many as it has fields.
    """
    listed = {r["table_name"]: r.asDict() for r in list_tables(spark, root).collect()}
    tables_at, fields_at = f"{store}/tables", f"{store}/fields"
    known = {}
    if current_version(spark, tables_at) is not None and current_version(spark, fields_at) is not None:
        rows = open_table(spark, tables_at).where(F.col("schema_name") == schema_name)
        known = {r["table_name"]: r["state"] for r in rows.select("table_name", "state").collect()}
    jobs = {name: (table, None) for name, table in listed.items() if known.get(name) != table["state"]}
    for name, (source, where) in (views or {}).items():
        if source in listed and known.get(name) != f"{listed[source]['state']} {where}":
            jobs[name] = ({"table_name": name, "state": f"{listed[source]['state']} {where}"}, (source, where))
    gone = [name for name in known if name not in listed and name not in (views or {})]

    def look(job) -> tuple[list, list]:
        table, view = job
        df = read_table_at(spark, listed[view[0]]["location"]).where(view[1]) if view else None
        return _look_into(spark, schema_name, table, df)

    names = list(jobs)
    for at in range(0, len(names), group):
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            found = list(pool.map(look, [jobs[n] for n in names[at:at + group]]))
        _store(spark, schema_name, names[at:at + group], tables_at, fields_at, found)
    if gone or current_version(spark, tables_at) is None:
        _store(spark, schema_name, gone, tables_at, fields_at, [])
    return open_catalog(spark, store)


def open_catalog(spark: SparkSession, store: str) -> Catalog:
    """The catalog as it was stored."""
    return Catalog(open_table(spark, f"{store}/tables"), open_table(spark, f"{store}/fields"))


def _store(spark: SparkSession, schema_name: str, names: Sequence[str], tables_at: str, fields_at: str, found: Sequence) -> None:
    """Fields first: a table counts as known only when its own row is there."""
    keys = spark.createDataFrame([(schema_name, n) for n in names], "schema_name string, table_name string")
    field_rows = spark.createDataFrame([f for _, fields in found for f in fields], _field_schema(spark))
    table_rows = spark.createDataFrame([row for row, _ in found], TABLE_COLUMNS)
    for path, rows in ((fields_at, define(field_rows)), (tables_at, table_rows)):
        rows = rows.coalesce(1)
        if current_version(spark, path) is None:
            publish(rows, path, expect=None)
        else:
            replace_by_keys(spark, path, keys, KEYS, rows)


def _field_schema(spark: SparkSession) -> T.StructType:
    empty = spark.createDataFrame([], "x int")
    return T.StructType([
        *[T.StructField(f.name, f.dataType) for f in crawl_table(empty, "", "").schema.fields], T.StructField("description", T.StringType()),
    ])


def schema_details(tables: DataFrame) -> DataFrame:
    """One row per schema: where its tables lie, when they came and changed, how many there are and how large."""
    real = tables.where("table_type <> 'VIEW'")
    return real.groupBy("schema_name").agg(
        F.min(F.regexp_replace("location", "/[^/]*$", "")).alias("location"), F.min("created").alias("created"), F.max("modified").alias("modified"),
        F.min("collation").alias("collation"), F.count("*").alias("table_count"), F.sum("row_count").alias("row_count"), F.sum("bytes").alias("bytes"),
    ).withColumn("ddl", F.concat(F.lit("CREATE SCHEMA "), "schema_name", F.lit(" LOCATION '"), "location", F.lit("'")))


def described_fields(fields: DataFrame) -> DataFrame:
    """Fields that carry a comment."""
    return fields.where("description IS NOT NULL").select("schema_name", "table_name", "field_path", "description", "value_count")
