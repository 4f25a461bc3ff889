"""The catalog: one row per field of every table, measured from the data.

Crawling is one aggregate per table, plus one per array of records. The result is stored once and every
catalog question is then a query on that small table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.records import long_form, measure, named, quoted
from tablewright.functions.types import array_depth, innermost, map_types, source_type
from tablewright.operators.keys import last_wins
from tablewright.session import scratch_path


@dataclass(frozen=True)
class _Field:
    """A place in a schema: where it is and how SQL text reaches it from the row at hand."""

    path: str
    ordinal: int
    dtype: T.DataType
    text: str
    parent: _Field | None = None

    @property
    def class_id(self) -> str | None:
        """Id of the record class the field holds: its own name at the top, ``parent;own`` below."""
        if not isinstance(innermost(self.dtype), T.StructType):
            return None
        name = self.path.split(".")[-1]
        own = name[:1].upper() + name[1:] + "Class"
        above = self.parent.class_id if self.parent else None
        return f"{above};{own}" if above else own


def _walk(schema: T.StructType, parent: _Field | None, row: str) -> Iterator[_Field]:
    """Fields reachable without entering an array."""
    for ordinal, f in enumerate(schema.fields):
        path = f"{parent.path}.{f.name}" if parent else f.name
        field = _Field(path, ordinal, f.dataType, row + named(f.name), parent)
        yield field
        if isinstance(f.dataType, T.StructType):
            yield from _walk(f.dataType, field, field.text + ".")


def _leaves(text: str, depth: int) -> str:
    """Number of innermost items in an array of ``depth`` levels."""
    if depth == 1:
        return f"size({text})"
    inner = _leaves(f"x{depth}", depth - 1)
    return f"aggregate({text}, 0L, (a, x{depth}) -> a + coalesce({inner}, 0))"


def crawl_table(df: DataFrame, schema_name: str, table: str, table_type: str = "BASE TABLE") -> DataFrame:
    """One row per field of a table, nested ones included, with measured counts.

    ``value_count`` is the number of non-null values, ``null_count`` the places
    where the holding record exists but the value does not, ``item_count`` and
    ``max_items`` the elements of an array field. One aggregate measures all
    fields up to the arrays; each array of records adds one over its own items,
    which reads no other column. On frames from ``load_counted`` the counts come
    from file footers and no column is read. ``row_count`` is null for fields inside arrays.
    """
    common = {"schema_name": quoted(schema_name), "table_name": quoted(table), "table_type": quoted(table_type)}
    return reduce(DataFrame.unionByName, _measure(df, df.schema, None, "", common))


def _measure(df: DataFrame, schema: T.StructType, holder: _Field | None, row: str, common: Mapping[str, str]) -> Iterator[DataFrame]:
    fields = list(_walk(schema, holder, row))
    places = {None: "n", holder: "n"}
    aggs = [measure(f"count({row.rstrip('.') or 1})", "n")]
    records = []
    for i, f in enumerate(fields):
        depth = array_depth(f.dtype)
        aggs.append(measure(f"count({f.text})", f"v{i}"))
        if depth:
            aggs += [measure(f"coalesce(sum({_leaves(f.text, depth)}), 0L)", f"i{i}"),
                     measure(f"coalesce(max(size({f.text})), 0)", f"x{i}")]
        places[f] = f"v{i}"
        records.append({
            **common, "field_path": quoted(f.path), "parent_path": quoted(f.parent.path if f.parent else ""),
            "column_name": quoted(f.path.split(".")[-1]), "ordinal": str(f.ordinal), "top_level": str(f.parent is None),
            "source_type": quoted(source_type(f.dtype)), "array_depth": str(depth),
            "class_id": quoted(f.class_id) if f.class_id else "cast(NULL AS STRING)",
            "row_count": "cast(NULL AS BIGINT)" if holder else "n", "value_count": f"v{i}",
            "null_count": f"{places[f.parent]} - v{i}", "item_count": f"i{i}" if depth else "0L",
            "max_items": f"cast(x{i} AS BIGINT)" if depth else "0L",
        })
    yield long_form(df.agg(*aggs), records)
    for f in fields:
        inner = innermost(f.dtype)
        if isinstance(f.dtype, T.ArrayType) and isinstance(inner, T.StructType):
            items = df.selectExpr(f"explode({f.text}) AS item")
            for _ in range(array_depth(f.dtype) - 1):
                items = items.selectExpr("explode(item) AS item")
            yield from _measure(items, inner, f, "item.", common)


def crawl(frames: Mapping[str, DataFrame], schema_name: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Fields of many tables with their type codes and defining class."""
    parts = [crawl_table(df, schema_name, name) for name, df in frames.items()]
    parts += [crawl_table(df, schema_name, name, "VIEW") for name, df in (views or {}).items()]
    return define(reduce(DataFrame.unionByName, parts))


def define(fields: DataFrame) -> DataFrame:
    """Add type code, nullability and ``defined_by``: a class, or one per array level around it."""
    inner = F.regexp_replace("source_type", "^REPEATED ", "")
    typed = map_types(fields.withColumn("__inner", inner), "__inner").withColumnRenamed("logical_class", "__class")
    holder = F.coalesce("class_id", "__class")
    wrapped = F.concat(F.repeat(F.lit("Collection("), F.col("array_depth")), holder, F.repeat(F.lit(")"), F.col("array_depth")))
    repeated = F.col("array_depth") > 0
    return typed.select(
        *fields.columns,
        F.when(repeated, F.lit(12)).otherwise(F.col("sql_code")).alias("sql_code"),
        F.lit(True).alias("nullable"),
        wrapped.alias("defined_by"),
    )


def tables_of(catalog: DataFrame) -> DataFrame:
    """One row per table; views are left out."""
    return (
        catalog.where((F.col("table_type") != "VIEW") & F.col("top_level"))
        .groupBy("schema_name", "table_name", "table_type")
        .agg(F.max("row_count").alias("row_count"), F.count("*").alias("column_count"))
    )


def schemas_of(catalog: DataFrame) -> DataFrame:
    """One row per schema."""
    return tables_of(catalog).groupBy("schema_name").agg(
        F.count("*").alias("table_count"), F.sum("row_count").alias("row_count")
    )


def columns_of(catalog: DataFrame, table: str) -> DataFrame:
    """Column names and types of one table."""
    return catalog.where((F.col("table_name") == F.lit(table)) & F.col("top_level")).select(
        "column_name", F.col("source_type").alias("data_type"), "ordinal"
    )


def field_totals(catalog: DataFrame) -> DataFrame:
    """Fields and values per table with the running number of fields.

    Tables are counted before the window, which therefore sees one row per table.
    """
    counted = catalog.groupBy("schema_name", "table_name").agg(
        F.count("*").alias("field_count"), F.sum("value_count").alias("value_count")
    )
    running = F.sum("field_count").over(Window.partitionBy("schema_name").orderBy("table_name"))
    return counted.select("table_name", "field_count", running.alias("running_total"), "value_count")


def descriptions_by_table(descriptions: DataFrame) -> DataFrame:
    """Per table a map of field path to description; the last entry for a path counts.

    A map is as long as a table has fields.
    """
    final = last_wins(descriptions.where(F.col("description").isNotNull()), ["table_name", "field_path"], ["position"])
    pairs = F.sort_array(F.collect_list(F.struct("field_path", "description")))
    return final.groupBy("table_name").agg(F.map_from_entries(pairs).alias("described"))


def in_scope(tables: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Keep or drop tables by ``schema``, ``schema.table`` or ``*.table`` patterns.

    The patterns are one-column frames. With an include list only its tables
    stay; the exclude list is then applied to what is left.
    """
    spellings = F.array(
        F.col("schema_name"), F.concat_ws(".", "schema_name", "table_name"), F.concat(F.lit("*."), F.col("table_name"))
    )
    spelled = tables.select("schema_name", "table_name", F.explode(spellings).alias("pattern"))
    keys = ["schema_name", "table_name"]
    kept = tables
    if include is not None and not include.isEmpty():
        wanted = include.select(F.col(include.columns[0]).alias("pattern")).distinct()
        kept = kept.join(spelled.join(wanted, "pattern", "left_semi").select(*keys).distinct(), keys, "left_semi")
    if exclude is not None:
        left_out = exclude.select(F.col(exclude.columns[0]).alias("pattern")).distinct()
        kept = kept.join(spelled.join(left_out, "pattern", "left_semi").select(*keys).distinct(), keys, "left_anti")
    return kept


def add_properties(fields: DataFrame, properties: DataFrame) -> DataFrame:
    """Attach user-given (table_name, field_path, property, property_value) rows to fields."""
    return fields.join(properties, ["table_name", "field_path"], "left")


def json_schema(df: DataFrame, column: str, longest: int = 1_000_000) -> str:
    """The type that holds every value of a text column of JSON, merged over the whole table.

    Where values of one place differ in kind, that place is a variant, which keeps them as they are.
    So is the column itself if its type takes more than ``longest`` characters to write, as with keys
    that are ids; ``json_fields`` then lists its paths as rows.
    """
    parsed = F.try_parse_json(F.col(column))
    found = df.agg(F.schema_of_variant_agg(parsed).alias("s")).where(F.length("s") <= longest).first()
    # quoted key names are left as they are
    return re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found["s"]) if found else "VARIANT"


def open_json(df: DataFrame, column: str, schema: str, rest: str | None = None) -> DataFrame:
    """Replace a text column of JSON by records of ``schema``; text that is no JSON stays in the column ``rest``, if named.

    Without ``rest`` such text becomes null.
    """
    fits = F.try_parse_json(F.col(column)).isNotNull()
    if rest is not None:
        df = df.withColumn(rest, F.when(~fits, F.col(column)))
    opened = F.try_parse_json(F.col(column)) if schema == "VARIANT" else F.when(fits, F.from_json(F.col(column), schema))
    return df.withColumn(column, opened)


def parse_complex(df: DataFrame, column: str, rest: str | None = None) -> DataFrame:
    """Replace a text column of JSON by the record it holds, by the schema of all its values."""
    return open_json(df, column, json_schema(df, column), rest)


def json_columns(df: DataFrame) -> list[str]:
    """Text columns whose every non-null value is a JSON object or array; one pass over all of them."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return []
    aggs = []
    for i, c in enumerate(names):
        kind = f"schema_of_variant(try_parse_json({named(c)}))"
        aggs += [measure(f"count({named(c)})", f"n{i}"), measure(f"count_if({kind} LIKE 'OBJECT%' OR {kind} LIKE 'ARRAY%')", f"j{i}")]
    found = df.agg(*aggs).first()
    return [c for i, c in enumerate(names) if found[f"n{i}"] and found[f"n{i}"] == found[f"j{i}"]]


def json_fields(df: DataFrame, column: str) -> DataFrame:
    """Every path inside a JSON text column with the kinds of value seen there and how often.

    Keys are never gathered into a schema: objects and arrays are opened level
    by level into rows, and (path, kind) pairs are counted on the map side. So
    a column with millions of different keys is only a longer result. The texts are parsed once: each level is
    written to the shared folder before the next one is opened from it, and a level holds what lies that deep and deeper.
    """
    spark, number = df.sparkSession, 0
    level = df.select(F.lit(column).alias("path"), F.try_parse_json(F.col(column)).alias("v")).where("v IS NOT NULL")
    kind = "regexp_extract(schema_of_variant(v), '^[A-Z]+', 0)"
    found = []
    while True:
        place = scratch_path(spark, f"json-{number}")
        level.select("path", "v", F.expr(kind).alias("kind")).write.parquet(place)
        level, number = spark.read.schema("path string, v variant, kind string").parquet(place), number + 1
        counted = level.groupBy(F.col("path").alias("field_path"), "kind").agg(F.count("*").alias("value_count"))
        found.append(counted.where("kind <> 'VOID'"))
        inner = level.where("kind IN ('OBJECT', 'ARRAY')")
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, found)
        objects = inner.where("kind = 'OBJECT'").selectExpr("path", "explode(cast(v AS map<string, variant>)) AS (k, v)")
        arrays = inner.where("kind = 'ARRAY'").selectExpr("path", "explode(cast(v AS array<variant>)) AS v")
        level = objects.selectExpr("concat(path, '.', k) AS path", "v").unionByName(arrays.selectExpr("concat(path, '[]') AS path", "v"))
        level = level.where("v IS NOT NULL")
