"""Key lookups, mappings, relations, ids and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import joins, keys, profiling
from tablewright.operators.masking import key_mapping
from tablewright.plans.reference_sql import catalog_sql, text, values
from tablewright.plans.registry import query
from tablewright.plans.tables import stored_catalog
from tablewright.plans.scans import DESCRIPTION_COLUMNS, DESCRIPTIONS, descriptions
from tablewright.rules.generators import GENERATORS
from tablewright.rules.patterns import NAME_PATTERNS, PERSONAL_CLASSES
from tablewright.sources import catalog
from tablewright.sources.tables import load, register, run_sql


@query(
    "join_sql_equi",
    "SELECT n_name, r_name, count(c_custkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey "
    "LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, r_name",
)
def join_sql_equi(spark, sf):
    register(spark, sf, "nation", "region", "customer")
    return run_sql(
        spark,
        "SELECT n_name, r_name, count(c_custkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey "
        "LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, r_name",
    )


@query(
    "join_parent_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')",
)
def join_parent_rows(spark, sf):
    chosen = load(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("id"))
    found = joins.child_rows(load(spark, sf, "orders"), chosen, "o_custkey", "id", "INTEGER")
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "join_entity_subset",
    "WITH c AS (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'), "
    "o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)), "
    "l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)) "
    "SELECT 'customer' AS table_name, count(*) AS n, sum(c_custkey)::BIGINT AS key_sum FROM c UNION ALL "
    "SELECT 'orders', count(*), sum(o_orderkey)::BIGINT FROM o UNION ALL "
    "SELECT 'lineitem', count(*), sum(l_orderkey)::BIGINT FROM l",
)
def join_entity_subset(spark, sf):
    found = joins.entity_subset(
        load(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'"),
        "customer",
        [
            ("orders", load(spark, sf, "orders"), "o_custkey", "customer", "c_custkey"),
            ("lineitem", load(spark, sf, "lineitem"), "l_orderkey", "orders", "o_orderkey"),
        ],
    )
    out = None
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        row = found[name].agg(F.count("*").alias("n"), F.sum(key).alias("key_sum")).select(F.lit(name).alias("table_name"), "n", "key_sum")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "join_missing_keys",
    "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def join_missing_keys(spark, sf):
    requested = load(spark, sf, "documents").select("doc_id")
    return joins.missing_keys(requested, load(spark, sf, "labels"), "doc_id")


@query(
    "join_descriptions",
    f"SELECT c.table_name, c.field_path, c.value_count, d.description FROM ({catalog_sql()}) c LEFT JOIN "
    f"(SELECT table_name, field_path, arg_max(description, position) AS description FROM "
    f"{values(DESCRIPTIONS, DESCRIPTION_COLUMNS)} WHERE description IS NOT NULL GROUP BY ALL) d USING (table_name, field_path)",
)
def join_descriptions(spark, sf):
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'").select("table_name", "field_path", "value_count")
    return joins.attach_descriptions(fields, descriptions(spark))


PARAMS = ((1, "doc_id", "5"), (2, "text", "x"), (3, "no_such_column", "1"), (4, "o_totalprice", "9.5"))


@query(
    "join_param_types",
    f"SELECT p.position, p.field_name, p.field_value, t.data_type FROM {values(PARAMS, 'position, field_name, field_value')} p "
    f"LEFT JOIN (SELECT column_name, arg_max(source_type, table_name) AS data_type FROM ({catalog_sql()}) GROUP BY column_name) t "
    f"ON t.column_name = p.field_name",
)
def join_param_types(spark, sf):
    params = spark.createDataFrame(list(PARAMS), "position int, field_name string, field_value string")
    columns = stored_catalog(spark, sf).where("table_type <> 'VIEW'").select(
        "column_name", F.col("table_name").alias("position"), F.col("source_type").alias("data_type")
    )
    return joins.param_types(params, columns)


REKEYED = (
    "WITH m AS (SELECT o_orderkey AS old, row_number() OVER (ORDER BY o_orderkey) AS new FROM orders) "
    "SELECT 'orders' AS table_name, m.new AS new_key, o_custkey AS other_key FROM orders JOIN m ON old = o_orderkey "
    "UNION ALL SELECT 'lineitem', coalesce(m.new, l_orderkey), l_linenumber FROM lineitem LEFT JOIN m ON old = l_orderkey"
)


@query("join_sequence_mapping", REKEYED)
def join_sequence_mapping(spark, sf):
    orders, lines = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    mapping = key_mapping([(orders, "o_orderkey")])
    parents = joins.replace_keys(orders.select("o_orderkey", "o_custkey"), mapping, "o_orderkey")
    children = joins.replace_keys(lines.select("l_orderkey", "l_linenumber"), mapping, "l_orderkey")
    return parents.select(
        F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("new_key"), F.col("o_custkey").alias("other_key")
    ).unionByName(children.select(
        F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("new_key"), F.col("l_linenumber").cast("bigint").alias("other_key")
    ))


@query(
    "join_parent_fields",
    "SELECT c_custkey AS owner_key, c_mktsegment AS segment, n::INT AS child_no FROM customer, "
    "(SELECT unnest(range(1, 4)) AS n) WHERE n <= 1 + c_nationkey % 3",
)
def join_parent_fields(spark, sf):
    customers = load(spark, sf, "customer")
    return joins.children_of(customers, {"c_custkey": "owner_key", "c_mktsegment": "segment"}, F.lit(1) + F.col("c_nationkey") % 3)


def _seen_classes(spark, sf):
    """Classes of the columns whose names tell one, one row per rule that matches."""
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'").select("table_name", "column_name")
    hits = profiling.name_matches(fields).select("table_name", "column_name", "class_name")
    # a class no list knows, to show the default
    return hits.unionByName(fields.where("column_name = 'props'").withColumn("class_name", F.lit("ZIP_CODE")))


def name_hits_sql() -> str:
    """Every name rule against every column, the two look-around rules written without it."""
    rules = []
    for i, (name, pattern, score) in enumerate(NAME_PATTERNS):
        if "(?<![A-Z])" in pattern:
            pattern = pattern.replace("(?<![A-Z])", "")
        if "(?<=" in pattern:
            tail = "[^iIdD].*|[iI](?:[^dD].*|$)|[dD](?:[^aA].*|[aA](?:[^tT].*|[tT](?:[^eE].*|$)|$)|$)|$"
            pattern = rf"(?:|.*[_-])(?i:NOTES?)(?:$|[_-](?:{tail})).*"
        rules.append((i, name, f"^(?:{pattern})$", score))
    return (
        f"SELECT c.table_name, c.column_name, r.rule_no, r.class_name, r.score::DOUBLE AS score FROM ({catalog_sql()}) c "
        f"JOIN {values(rules, 'rule_no, class_name, pattern, score')} r ON regexp_matches(c.column_name, r.pattern)"
    )


SEEN = (
    f"(SELECT table_name, column_name, class_name FROM ({name_hits_sql()}) UNION ALL "
    f"SELECT 'events', 'props', 'ZIP_CODE' FROM (SELECT count(*) FROM events))"
)


@query(
    "join_classification_pii",
    f"SELECT table_name, column_name, class_name, class_name IN ({', '.join(text(c) for c in PERSONAL_CLASSES)}) AS pii FROM {SEEN}",
)
def join_classification_pii(spark, sf):
    return profiling.mark_pii(_seen_classes(spark, sf))


@query(
    "join_classification_generator",
    f"SELECT s.table_name, s.column_name, s.class_name, g.generator, g.consistent, g.unique_values FROM {SEEN} s LEFT JOIN "
    f"{values([(c, g, same, once) for c, g, _, same, once in GENERATORS], 'class_name, generator, consistent, unique_values')} g "
    f"ON g.class_name = s.class_name",
)
def join_classification_generator(spark, sf):
    return profiling.attach_generators(_seen_classes(spark, sf)).drop("params")


@query("join_name_pattern", name_hits_sql())
def join_name_pattern(spark, sf):
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'").select("table_name", "column_name")
    return profiling.name_matches(fields)


KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
    "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"],
    "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}
_key_list = ", ".join(f"('{t}', '{c}')" for t, cols in KEYS.items() for c in cols)


@query(
    "join_relation_candidates",
    f"WITH f AS (SELECT table_name AS t, column_name AS c, replace(regexp_replace(lower(column_name), '^[a-z]{{1,2}}_', ''), '_', '') AS norm, "
    f"(table_name, column_name) IN ({_key_list}) AS pk FROM ({catalog_sql()}) WHERE source_type NOT LIKE 'FLOAT%' AND value_count > 0), "
    f"k AS (SELECT t, count(*) AS n FROM (VALUES {_key_list}) v(t, c) GROUP BY t), "
    f"g AS (SELECT f.*, k.n FROM f JOIN k USING (t) WHERE norm NOT IN ('name', 'username')), "
    f"p AS (SELECT a.t AS from_table, b.t AS to_table, a.c AS from_field, b.c AS to_field, "
    f"CASE WHEN a.pk AND NOT b.pk AND a.n = 1 THEN 'single_field_pk_and_not_pk' WHEN a.pk AND b.pk AND a.n < b.n THEN 'common_fields_in_both_pk' "
    f"WHEN a.pk AND b.pk AND a.n = b.n THEN 'same_field_names_pk' WHEN NOT a.pk AND NOT b.pk THEN 'same_field_names_not_pk' END AS rule "
    f"FROM g a JOIN g b ON a.norm = b.norm AND a.t <> b.t), "
    f"s AS (SELECT *, CASE rule WHEN 'single_field_pk_and_not_pk' THEN 0.8 WHEN 'common_fields_in_both_pk' THEN 0.8 "
    f"WHEN 'same_field_names_pk' THEN 0.4 ELSE 0.2 END::DOUBLE AS score FROM p WHERE rule IS NOT NULL) "
    f"SELECT from_table, to_table, score, from_field, to_field, rule FROM s WHERE score >= 0.4 "
    f"QUALIFY row_number() OVER (PARTITION BY from_table, to_table ORDER BY score DESC, from_field DESC, to_field DESC) = 1",
)
def join_relation_candidates(spark, sf):
    pairs = spark.createDataFrame([(t, c, True) for t, cols in KEYS.items() for c in cols], "table_name string, field_name string, is_pk boolean")
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW' AND top_level AND value_count > 0").select(
        "table_name", F.col("column_name").alias("field_name"), "source_type"
    )
    marked = fields.join(pairs, ["table_name", "field_name"], "left").withColumn("is_pk", F.coalesce("is_pk", F.lit(False)))
    return joins.relation_candidates(marked)


@query("window_sequence_ids", "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS seq_id FROM orders")
def window_sequence_ids(spark, sf):
    return keys.dense_ids(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@query(
    "window_batch_number",
    "SELECT batch_no, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM "
    "(SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch_no FROM orders) GROUP BY batch_no",
)
def window_batch_number(spark, sf):
    numbered = keys.batch_numbers(load(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0)
    return numbered.groupBy("batch_no").agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "window_ordinal_position",
    "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS position FROM lineitem",
)
def window_ordinal_position(spark, sf):
    return keys.positions(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], ["l_linenumber"])


@query(
    "window_last_wins",
    "SELECT user_id, event_id, event_type, ts FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def window_last_wins(spark, sf):
    events = load(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return keys.last_wins(events, ["user_id"], ["ts", "event_id"])
