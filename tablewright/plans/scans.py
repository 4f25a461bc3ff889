"""Reads, catalog questions, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.joins import attach_descriptions, scope
from tablewright.operators.keys import collect_in_parts
from tablewright.plans.reference_sql import catalog_sql, columns as ref_columns, values
from tablewright.plans.registry import query
from tablewright.plans.tables import TABLES, TASK_SETTINGS, folder_catalog, stored_catalog, task_settings
from tablewright.session import scratch_path
from tablewright.sources import catalog, folders, tables
from tablewright.sources.tables import load, register

DESCRIPTIONS = (
    ("customer", "c_custkey", "customer id", 0),
    ("customer", "c_name", "display name", 1),
    ("customer", "c_name", "name of the customer", 2),
    ("orders", "o_totalprice", None, 3),
    ("orders", "o_orderstatus", "F, O or P", 4),
    ("events", "props", "JSON text", 5),
)
DESCRIPTION_COLUMNS = "table_name, field_path, description, position"


def descriptions(spark):
    return spark.createDataFrame(
        list(DESCRIPTIONS), "table_name string, field_path string, description string, position int"
    )


def names(spark, *items):
    return spark.createDataFrame([(i,) for i in items], "name string")


query("scan_table", "SELECT * FROM nation")(lambda spark, sf: load(spark, sf, "nation"))


@query(
    "scan_projected_filtered_limited",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 500",
)
def scan_projected_filtered_limited(spark, sf):
    rows = tables.read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"], "o_orderstatus = 'F'")
    return tables.take(rows.orderBy("o_orderkey"), 500)


@query(
    "sql_query_params",
    "SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM customer "
    "JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 1000.0 AND o_orderstatus IN ('F', 'O') GROUP BY c_mktsegment",
)
def sql_query_params(spark, sf):
    register(spark, sf, "customer", "orders")
    return tables.run_sql(
        spark,
        "SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM customer "
        "JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > ? AND array_contains(?, o_orderstatus) GROUP BY c_mktsegment",
        [1000.0, F.array(F.lit("F"), F.lit("O"))],
    )


@query("fetch_scalar", "SELECT max(o_totalprice) AS value FROM orders")
def fetch_scalar(spark, sf):
    return tables.first_value(load(spark, sf, "orders").agg(F.max("o_totalprice")))


@query(
    "catalog_schemas",
    f"SELECT schema_name, count(*) AS table_count, sum(row_count)::BIGINT AS row_count FROM "
    f"(SELECT schema_name, table_name, max(row_count) AS row_count FROM ({catalog_sql()}) GROUP BY ALL) GROUP BY schema_name",
)
def catalog_schemas(spark, sf):
    return catalog.schemas_of(stored_catalog(spark, sf))


@query(
    "catalog_tables",
    f"SELECT schema_name, table_name, 'BASE TABLE' AS table_type, max(row_count) AS row_count, count(*) AS column_count "
    f"FROM ({catalog_sql()}) GROUP BY schema_name, table_name",
)
def catalog_tables(spark, sf):
    return catalog.tables_of(stored_catalog(spark, sf))


_DDL_TYPES = {"INT64": "BIGINT", "FLOAT64": "DOUBLE", "STRING": "STRING", "DATETIME": "TIMESTAMP_NTZ", "REPEATED FLOAT64": "ARRAY<FLOAT>"}


_INTS = ("quality", "toxic", "l_linenumber", "p_size", "label", "r_regionkey", "n_nationkey", "n_regionkey", "c_nationkey", "s_nationkey")


def _ddl_sql(table):
    listed = ", ".join(f"{c} {_DDL_TYPES[k] if c not in _INTS else 'INT'}" for c, k in ref_columns(table))
    return f"CREATE TABLE main.{table} ({listed}) USING parquet"


@query(
    "catalog_table_details",
    " UNION ALL ".join(
        f"SELECT 'main' AS schema_name, '{t}' AS table_name, 'BASE TABLE' AS table_type, count(*) AS row_count, {len(ref_columns(t))}::BIGINT AS column_count, "
        f"'UTF8_BINARY' AS collation, '{_ddl_sql(t)}' AS ddl, true AS has_files, true AS times_in_order FROM {t}"
        for t in TABLES
    ),
)
def catalog_table_details(spark, sf):
    """Location, sizes and times differ from place to place, so the check holds what they must satisfy."""
    found = folder_catalog(spark, sf).tables.where("table_type <> 'VIEW'")
    return found.select(
        "schema_name", "table_name", "table_type", "row_count", "column_count", "collation", "ddl",
        ((F.col("file_count") > 0) & (F.col("bytes") > 0) & F.col("location").startswith(sf)).alias("has_files"),
        (F.col("created") <= F.col("modified")).alias("times_in_order"),
    )


@query(
    "catalog_schema_details",
    "SELECT 'main' AS schema_name, 'UTF8_BINARY' AS collation, 14::BIGINT AS table_count, ("
    + " + ".join(f"(SELECT count(*) FROM {t})" for t in TABLES) + ")::BIGINT AS row_count, true AS here",
)
def catalog_schema_details(spark, sf):
    found = folders.schema_details(folder_catalog(spark, sf).tables)
    here = (F.col("location") == F.lit(sf.rstrip("/"))) & (F.col("created") <= F.col("modified")) & F.col("ddl").endswith(F.concat(F.lit("LOCATION '"), "location", F.lit("'")))
    return found.select("schema_name", "collation", "table_count", "row_count", here.alias("here"))


@query(
    "catalog_column_comments",
    "SELECT 'people' AS table_name, 'c_name' AS field_path, 'who it is' AS description, count(c_name) AS value_count FROM customer UNION ALL "
    "SELECT 'people', 'place.nation', 'where it''s from', count(*) FROM customer UNION ALL "
    "SELECT 'goods', 'p_name', 'what it is', count(p_name) FROM part",
)
def catalog_column_comments(spark, sf):
    """Two tables are stored with comments on their columns; the catalog of their folder tells them."""
    said = lambda c, text: F.col(c).alias(c, metadata={"comment": text})
    path, people, goods = scratch_path(spark, "commented"), load(spark, sf, "customer"), load(spark, sf, "part")
    place = T.StructType([T.StructField("nation", T.LongType(), True, {"comment": "where it's from"})])
    people = people.select("c_custkey", said("c_name", "who it is"), F.struct(F.col("c_nationkey").alias("nation")).cast(place).alias("place"))
    people.to(T.StructType([*people.schema.fields[:2], T.StructField("place", place)])).write.parquet(f"{path}/data/people")
    goods.select("p_partkey", said("p_name", "what it is")).write.parquet(f"{path}/data/goods.parquet")
    found = folders.crawl_folder(spark, f"{path}/data", f"{path}/catalog").fields
    return folders.described_fields(found).drop("schema_name")


@query(
    "catalog_columns",
    f"SELECT column_name, source_type AS data_type, ordinal FROM ({catalog_sql()}) WHERE table_name = 'lineitem'",
)
def catalog_columns(spark, sf):
    return catalog.columns_of(stored_catalog(spark, sf), "lineitem")


@query(
    "catalog_field_descriptions",
    f"SELECT c.table_name, c.field_path, d.description, c.value_count FROM ({catalog_sql()}) c JOIN "
    f"(SELECT table_name, field_path, arg_max(description, position) AS description FROM "
    f"{values(DESCRIPTIONS, DESCRIPTION_COLUMNS)} WHERE description IS NOT NULL GROUP BY ALL) d USING (table_name, field_path)",
)
def catalog_field_descriptions(spark, sf):
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'")
    described = attach_descriptions(fields, descriptions(spark))
    return described.where("description IS NOT NULL").select("table_name", "field_path", "description", "value_count")


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TABLES),
)
def table_row_counts(spark, sf):
    return tables.row_counts({name: tables.load_counted(spark, sf, name) for name in TABLES})


SAMPLED = (("region", "r_regionkey"), ("supplier", "s_suppkey"), ("lineitem", "l_orderkey, l_linenumber"))


@query(
    "snapshot_sample",
    " UNION ALL ".join(
        f"(SELECT '{t}' AS table_name, {k.split(',')[0]} AS sample_key FROM {t} ORDER BY {k} "
        f"LIMIT (SELECT CASE WHEN count(*) * 10 // 100 < 10 THEN 10 WHEN count(*) * 10 // 100 >= 100 THEN 100 "
        f"ELSE count(*) * 10 // 100 END FROM {t}))"
        for t, k in SAMPLED
    ),
)
def snapshot_sample(spark, sf):
    out = None
    for name, key in SAMPLED:
        order = key.split(", ")
        rows = tables.sample(load(spark, sf, name), order=order)
        part = rows.select(F.lit(name).alias("table_name"), F.col(order[0]).cast("bigint").alias("sample_key"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "config_table_lookup",
    f"SELECT t.table_name, t.row_count, coalesce(s.extract_step, d.extract_step) AS extract_step, "
    f"coalesce(s.load_step, d.load_step) AS load_step, coalesce(s.table_order, d.table_order) AS table_order "
    f"FROM (SELECT table_name, max(row_count) AS row_count FROM ({catalog_sql()}) GROUP BY table_name) t "
    f"JOIN {values(TASK_SETTINGS, 'table_name, extract_step, load_step, table_order')} d ON d.table_name = '' "
    f"LEFT JOIN {values(TASK_SETTINGS, 'table_name, extract_step, load_step, table_order')} s ON s.table_name = t.table_name",
)
def config_table_lookup(spark, sf):
    found = catalog.tables_of(stored_catalog(spark, sf)).select("table_name", "row_count")
    return tables.pick_settings(found, task_settings(spark), "table_name")


@query(
    "generate_range_rows",
    "SELECT 'baby_' || i AS name, 'M' AS assigned_sex_at_birth, i AS count "
    "FROM (SELECT unnest(range((SELECT count(*) FROM part))) AS i)",
)
def generate_range_rows(spark, sf):
    rows = tables.numbered_rows(spark, load(spark, sf, "part").count())
    return rows.select(
        F.format_string("baby_%d", "i").alias("name"), F.lit("M").alias("assigned_sex_at_birth"), F.col("i").alias("count")
    )


@query("document_source_explode", "SELECT conv_id, turn, role, text FROM conversations")
def document_source_explode(spark, sf):
    nested = collect_in_parts(load(spark, sf, "conversations"), ["conv_id"], ["turn"], ["turn", "role", "text"], "turns")
    return tables.explode_field(nested, ["conv_id"], "turns")


@query("limit_rows", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 200")
def limit_rows(spark, sf):
    return tables.take(load(spark, sf, "events").select("event_id", "event_type").orderBy("event_id"), 200)


@query(
    "limit_capped_query",
    "WITH big AS (SELECT * FROM orders WHERE o_totalprice > 1000) "
    "SELECT o_orderkey, o_orderstatus, 'limit 5' AS note FROM big ORDER BY o_orderkey LIMIT 1000",
)
def limit_capped_query(spark, sf):
    register(spark, sf, "orders")
    return tables.run_capped(
        spark,
        "WITH big AS (SELECT * FROM orders WHERE o_totalprice > ?) "
        "SELECT o_orderkey, o_orderstatus, 'limit 5' AS note FROM big ORDER BY o_orderkey;",
        params=[1000.0],
    )


@query(
    "limit_sample_clamp",
    "SELECT table_name, row_count, CASE WHEN row_count * 10 // 100 < 10 THEN 10 WHEN row_count * 10 // 100 >= 1000 THEN 1000 "
    "ELSE row_count * 10 // 100 END::BIGINT AS sample_rows FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TABLES)
    + ")",
)
def limit_sample_clamp(spark, sf):
    counts = tables.row_counts({name: tables.load_counted(spark, sf, name) for name in TABLES})
    return counts.withColumn("sample_rows", tables.sample_size(F.col("row_count")))


@query(
    "set_union_append",
    "SELECT c_custkey AS party_key, c_name AS party_name, 'customer' AS kind FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier",
)
def set_union_append(spark, sf):
    customers = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"), F.lit("customer").alias("kind")
    )
    suppliers = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name"), F.lit("supplier").alias("kind")
    )
    return customers.unionByName(suppliers)


@query(
    "set_include_minus_exclude",
    f"WITH wanted AS (SELECT unnest(['customer', 'orders', 'lineitem']) AS n EXCEPT SELECT 'orders') "
    f"SELECT table_name, column_name, row_count FROM ({catalog_sql()}) WHERE table_name IN (SELECT n FROM wanted)",
)
def set_include_minus_exclude(spark, sf):
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'")
    kept = scope(fields, "table_name", names(spark, "customer", "orders", "lineitem"), names(spark, "orders"))
    return kept.select("table_name", "column_name", "row_count")
