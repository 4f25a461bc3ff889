"""Crawling and classifying the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import changes, profiles, profiling
from tablewright.operators.changes import open_table, publish
from tablewright.operators.discovery import discover
from tablewright.operators.keys import collect_in_parts
from tablewright.plans.aggregates import best_sql, data_hits_sql, text_sources
from tablewright.plans.joining import name_hits_sql
from tablewright.plans.reference_sql import catalog_sql, columns, text, values
from tablewright.plans.registry import query
from tablewright.plans.tables import TABLES, stored_catalog
from tablewright.plans.scans import names
from tablewright.rules.patterns import NAME_PATTERNS, PERSONAL_CLASSES
from tablewright.session import scratch_path
from tablewright.sources import catalog
from tablewright.sources.tables import load, load_all


def nested_orders(spark, sf):
    """A stored table of orders with their lines as records, each with a price record and an array of dates.

    An order with very many lines has several rows, told apart by ``part``; its head stands in the first.
    """
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("line_no"),
        F.struct(F.col("l_extendedprice").alias("amount"), F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount")).alias("price"),
        F.array("l_shipdate").alias("dates"),
    )
    docs = collect_in_parts(lines, ["l_orderkey"], ["line_no"], ["line_no", "price", "dates"], "lines")
    heads = load(spark, sf, "orders").select("o_orderkey", F.struct("o_orderstatus", "o_totalprice").alias("head"))
    path = scratch_path(spark, "nested")
    found = heads.join(docs.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("part", F.lit(0)).alias("part"), F.when(F.coalesce("part", F.lit(0)) == 0, F.col("head")).alias("head"), "lines",
    )
    publish(found, path)
    return open_table(spark, path)


_ROWS = "(SELECT count(*) FROM orders)"
_CUT = "(SELECT DISTINCT l_orderkey, part FROM (SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey) - 1) // 10000 AS part FROM lineitem))"
_PARTS = f"(SELECT count(*) FROM orders LEFT JOIN {_CUT} ON l_orderkey = o_orderkey)"
_FILLED = f"(SELECT count(*) FROM orders JOIN {_CUT} ON l_orderkey = o_orderkey)"
_LINES = "(SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
_NESTED = (
    ("o_orderkey", 0, True, "INT64", "INTEGER", _PARTS, "0", "0"),
    ("part", 1, True, "INT64", "INTEGER", _PARTS, "0", "0"),
    ("head", 2, True, "STRUCT", "HeadClass", _ROWS, f"{_PARTS} - {_ROWS}", "0"),
    ("head.o_orderstatus", 0, False, "STRING", "STRING", _ROWS, f"{_PARTS} - {_ROWS}", "0"),
    ("head.o_totalprice", 1, False, "FLOAT64", "REAL", _ROWS, f"{_PARTS} - {_ROWS}", "0"),
    ("lines", 3, True, "REPEATED STRUCT", "Collection(LinesClass)", _FILLED, f"{_PARTS} - {_FILLED}", _LINES),
    ("lines.line_no", 0, False, "INT64", "INTEGER", _LINES, "0", "0"),
    ("lines.price", 1, False, "STRUCT", "LinesClass;PriceClass", _LINES, "0", "0"),
    ("lines.price.amount", 0, False, "FLOAT64", "REAL", _LINES, "0", "0"),
    ("lines.price.discount", 1, False, "FLOAT64", "REAL",
     "(SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_discount > 0)",
     "(SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE NOT l_discount > 0)", "0"),
    ("lines.dates", 2, False, "REPEATED DATETIME", "Collection(DATETIME)", _LINES, "0", _LINES),
)


@query(
    "crawl_fields_flat",
    " UNION ALL ".join(
        f"SELECT '{p}' AS field_path, {o} AS ordinal, {str(t).lower()} AS top_level, '{k}' AS source_type, "
        f"{v}::BIGINT AS value_count, ({n})::BIGINT AS null_count, {i}::BIGINT AS item_count"
        for p, o, t, k, _, v, n, i in _NESTED
    ),
)
def crawl_fields_flat(spark, sf):
    found = catalog.crawl({"nested_orders": nested_orders(spark, sf)}, "main")
    return found.select("field_path", "ordinal", "top_level", "source_type", "value_count", "null_count", "item_count")


@query(
    "crawl_nested_classes",
    " UNION ALL ".join(
        f"SELECT '{p}' AS field_path, '{d}' AS defined_by, {str(d.find('Class') >= 0).lower()} AS holds_record, {v}::BIGINT AS value_count"
        for p, _, _, _, d, v, _, _ in _NESTED
    ),
)
def crawl_nested_classes(spark, sf):
    found = catalog.crawl({"nested_orders": nested_orders(spark, sf)}, "main")
    return found.select("field_path", "defined_by", F.col("class_id").isNotNull().alias("holds_record"), "value_count")


TOKENS = "(SELECT unnest(regexp_split_to_array(text, '\\s+')) AS token FROM documents)"


#: Every table with a text column.
WITH_TEXT = tuple(t for t in TABLES if any(kind == "STRING" for _, kind in columns(t)))


@query(
    "classify_by_data",
    "SELECT * REPLACE (round(score, 6) AS score) FROM ("
    + best_sql(
        data_hits_sql(text_sources("documents", "pages", "conversations", "customer") + [("words", "token", TOKENS)]), 0.000001
    )
    + ")",
)
def classify_by_data(spark, sf):
    frames = load_all(spark, sf, WITH_TEXT)
    frames["words"] = load(spark, sf, "documents").select(F.explode(F.split("text", r"\s+")).alias("token"))
    return profiling.classify_by_data(frames, threshold=0.000001).withColumn("score", F.round("score", 6))


@query(
    "discover_tables",
    "SELECT c.table_name, c.field_path, c.ordinal, c.source_type, c.defined_by, c.value_count, k.class_name, round(k.score, 6) AS score, k.pii, "
    "round(CASE WHEN c.ordinal >= 0 AND instr(c.field_path, '.') = 0 THEN c.null_count / c.row_count END, 6) AS null_share FROM ("
    f"SELECT table_name, field_path, ordinal, CASE field_path WHEN 'props' THEN 'STRUCT' ELSE source_type END AS source_type, "
    f"CASE field_path WHEN 'props' THEN 'PropsClass' ELSE defined_by END AS defined_by, value_count, null_count, row_count FROM "
    f"({catalog_sql(tables=('nation', 'customer', 'events', 'conversations'))}) UNION ALL "
    "SELECT 'events', 'props.k', 0, 'INT64', 'INTEGER', count(props->>'$.k'), 0, NULL FROM events) c LEFT JOIN ("
    "SELECT *, class_name IN (" + ", ".join(text(c) for c in PERSONAL_CLASSES) + ") AS pii FROM ("
    + best_sql(
        f"SELECT * FROM ({name_hits_sql()}) WHERE table_name IN ('nation', 'customer', 'events', 'conversations') UNION ALL "
        f"SELECT table_name, column_name, rule_no + {len(NAME_PATTERNS)}, class_name, score FROM "
        f"({data_hits_sql([x for x in text_sources('nation', 'customer', 'events', 'conversations') if x[1] != 'props'])})",
        0.01,
    )
    + ")) k ON k.table_name = c.table_name AND k.column_name = c.field_path",
)
def discover_tables(spark, sf):
    frames = load_all(spark, sf, ("region", "nation", "customer", "events", "conversations"))
    found = discover(frames, "main", exclude=names(spark, "*.region"), whole=True, threshold=0.01)
    return found.select(
        "table_name", "field_path", "ordinal", "source_type", "defined_by", "value_count", "class_name",
        F.round("score", 6).alias("score"), "pii", F.round("null_share", 6).alias("null_share"),
    )


@query("classify_by_name", best_sql(name_hits_sql(), 0.4))
def classify_by_name(spark, sf):
    return profiling.classify_by_name(stored_catalog(spark, sf).where("table_type <> 'VIEW'").select("table_name", "column_name"))


_TEXT_TABLES = ("region", "nation", "customer", "supplier", "part", "documents", "conversations")


@query(
    "classify_pii_columns",
    "SELECT table_name, column_name, class_name, round(score, 6) AS score, class_name IN ("
    + ", ".join(text(c) for c in PERSONAL_CLASSES) + ") AS pii FROM ("
    + best_sql(
        f"SELECT * FROM ({name_hits_sql()}) UNION ALL SELECT table_name, column_name, rule_no + {len(NAME_PATTERNS)}, class_name, score FROM "
        f"({data_hits_sql(text_sources(*_TEXT_TABLES))})",
        0.01,
    )
    + ")",
)
def classify_pii_columns(spark, sf):
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'").select("table_name", "column_name")
    found = profiling.classify(fields, load_all(spark, sf, _TEXT_TABLES), threshold=0.01)
    return found.withColumn("score", F.round("score", 6))


def _profile_sql(table, keep):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value, count(DISTINCT {c}) AS distinct_count FROM {table}"
        for c, _ in columns(table) if c in keep
    )


_PROFILED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "props"],
}


@query("profile_table", " UNION ALL ".join(_profile_sql(t, keep) for t, keep in _PROFILED.items()))
def profile_table(spark, sf):
    out = None
    for name, keep in _PROFILED.items():
        part = profiling.profile(load(spark, sf, name).select(*keep), name, exact_distinct=True)
        out = part if out is None else out.unionByName(part)
    return out


def _shown(column, kind):
    """Bounds of floats are shown with four decimals, as engines write floats in their own ways."""
    return f"({column})::DECIMAL(18,4)::VARCHAR" if kind == "FLOAT64" else f"({column})::VARCHAR"


def _whole_profile_sql(table, distinct):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"{_shown(f'min({c})', k)} AS min_value, {_shown(f'max({c})', k)} AS max_value, {distinct.format(c=c)} FROM {table}"
        for c, k in columns(table)
    )


def _float_bounds(found, *tables):
    floats = [c for t in tables for c, k in columns(t) if k == "FLOAT64"]
    for c in ("min_value", "max_value"):
        shown = F.col(c).cast("double").cast("decimal(18,4)").cast("string")
        found = found.withColumn(c, F.when(F.col("column_name").isin(floats), shown).otherwise(F.col(c)))
    return found


@query(
    "profile_all_columns",
    " UNION ALL ".join(_whole_profile_sql(t, "count(DISTINCT {c}) AS distinct_count") for t in ("lineitem", "events", "orders", "part")),
)
def profile_all_columns(spark, sf):
    """Every column of four tables, distinct values counted exactly."""
    parts = [profiling.profile(load(spark, sf, t), t, exact_distinct=True) for t in ("lineitem", "events", "orders", "part")]
    return _float_bounds(reduce(DataFrame.unionByName, parts), "lineitem", "events", "orders", "part")


@query("profile_grown_table", _whole_profile_sql("lineitem", "true AS distinct_is_near"))
def profile_grown_table(spark, sf):
    """A table that was profiled, grew and lost rows that came back; only what was written since is measured again."""
    path, lines = scratch_path(spark, "grown"), load(spark, sf, "lineitem")
    table, store = f"{path}/table", f"{path}/states"
    changes.publish(lines.where("l_linenumber = 1"), table)
    profiles.update_profile(spark, table, store)
    changes.publish_more(lines.where("l_linenumber > 1"), table)
    profiles.update_profile(spark, table, store)
    some = lines.where("l_orderkey % 50 = 1")
    changes.delete_by_keys(spark, table, some, ["l_orderkey"])
    changes.publish_more(some, table)
    found = _float_bounds(profiles.read_profile(spark, table, store, "lineitem"), "lineitem")
    exact = profiling.profile(lines, "lineitem", exact_distinct=True).select("column_name", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(2), F.col("exact") * 0.08)
    return found.join(exact, "column_name").withColumn("distinct_is_near", near).drop("distinct_count", "exact")


PROPERTIES = (("customer", "c_name", "owner", "sales"), ("orders", "o_totalprice", "unit", "USD"), ("orders", "o_totalprice", "owner", "finance"))


@query(
    "add_custom_property",
    f"SELECT c.table_name, c.field_path, c.value_count, p.property, p.property_value FROM ({catalog_sql()}) c LEFT JOIN "
    f"{values(PROPERTIES, 'table_name, field_path, property, property_value')} p USING (table_name, field_path)",
)
def add_custom_property(spark, sf):
    properties = spark.createDataFrame(list(PROPERTIES), "table_name string, field_path string, property string, property_value string")
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'").select("table_name", "field_path", "value_count")
    return catalog.add_properties(fields, properties)


@query(
    "parse_complex_fields",
    "SELECT 'props' AS field_path, 'STRUCT' AS source_type, count(props) AS value_count, count(*) - count(props) AS null_count FROM events "
    "UNION ALL SELECT 'props.k', 'INT64', count(props->>'$.k'), count(props) - count(props->>'$.k') FROM events "
    "UNION ALL SELECT 'event_id', 'INT64', count(*), 0 FROM events",
)
def parse_complex_fields(spark, sf):
    parsed = catalog.parse_complex(load(spark, sf, "events").select("event_id", "props"), "props")
    return catalog.crawl_table(parsed, "main", "events").select("field_path", "source_type", "value_count", "null_count")


@query(
    "parse_complex_unknown_keys",
    "SELECT 'j' AS field_path, 'OBJECT' AS kind, count(*) AS value_count FROM events UNION ALL "
    "SELECT 'j.who', 'OBJECT', count(*) FROM events UNION ALL SELECT 'j.who.id', 'BIGINT', count(*) FROM events UNION ALL "
    "SELECT 'j.who.' || event_type, 'STRING', count(*) FROM events GROUP BY event_type UNION ALL "
    "SELECT 'j.tags', 'ARRAY', count(*) FROM events UNION ALL SELECT 'j.tags[]', 'STRING', 2 * count(*) FROM events UNION ALL "
    "SELECT 'j.props', 'OBJECT', count(props) FROM events UNION ALL SELECT 'j.props.k', 'BIGINT', count(props->>'$.k') FROM events",
)
def parse_complex_unknown_keys(spark, sf):
    text = F.concat(
        F.lit('{"who":{"id":'), F.col("user_id").cast("string"), F.lit(',"'), F.col("event_type"), F.lit('":"x"},"tags":["a","b"],"none":null,"props":'),
        F.coalesce("props", F.lit("null")), F.lit("}"),
    )
    return catalog.json_fields(load(spark, sf, "events").select(text.alias("j")), "j")


@query(
    "crawl_scope_filter",
    f"SELECT table_name, max(row_count) AS row_count FROM ({catalog_sql()}) WHERE table_name NOT IN ('events', 'labels') GROUP BY table_name",
)
def crawl_scope_filter(spark, sf):
    found = catalog.tables_of(stored_catalog(spark, sf))
    kept = catalog.in_scope(found, include=names(spark, "main"), exclude=names(spark, "*.events", "main.labels", "other"))
    return kept.select("table_name", "row_count")
