"""Counts, null shares, pattern shares and collected arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import keys, profiling
from tablewright.operators.filters import typed_filter
from tablewright.plans.reference_sql import catalog_sql, columns, text, values
from tablewright.plans.registry import query
from tablewright.plans.tables import stored_catalog
from tablewright.plans.scans import DESCRIPTION_COLUMNS, DESCRIPTIONS, descriptions
from tablewright.rules.patterns import DATA_PATTERNS
from tablewright.sources import catalog, tables
from tablewright.sources.tables import load


@query("agg_count_where", "SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 10")
def agg_count_where(spark, sf):
    rows = typed_filter(load(spark, sf, "lineitem"), "l_returnflag = ? and l_quantity > ?", [("l_returnflag", "R"), ("l_quantity", "10")])
    return rows.agg(F.count("*").alias("n"))


@query(
    "agg_count_optional",
    "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', -1",
)
def agg_count_optional(spark, sf):
    out = None
    for name, wanted in (("orders", "true"), ("lineitem", "false")):
        part = tables.optional_count(load(spark, sf, name), name, wanted)
        out = part if out is None else out.unionByName(part)
    return out


@query("agg_distinct_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def agg_distinct_keys(spark, sf):
    return load(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("agg_running_record_count", "SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS total FROM events GROUP BY event_type")
def agg_running_record_count(spark, sf):
    return tables.counts_with_total(load(spark, sf, "events"), "event_type")


@query(
    "agg_group_descriptions",
    f"SELECT c.table_name, c.row_count, string_agg(d.field_path || '=' || d.description, ';' ORDER BY d.field_path) AS described FROM "
    f"(SELECT table_name, max(row_count) AS row_count FROM ({catalog_sql()}) GROUP BY table_name) c JOIN "
    f"(SELECT table_name, field_path, arg_max(description, position) AS description FROM "
    f"{values(DESCRIPTIONS, DESCRIPTION_COLUMNS)} WHERE description IS NOT NULL GROUP BY ALL) d USING (table_name) GROUP BY ALL",
)
def agg_group_descriptions(spark, sf):
    grouped = catalog.descriptions_by_table(descriptions(spark))
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("described")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    found = catalog.tables_of(stored_catalog(spark, sf)).select("table_name", "row_count")
    return found.join(grouped, "table_name").select("table_name", "row_count", listed.alias("described"))


def _null_sql(table, expression):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, avg(CASE WHEN {expression(c)} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_share "
        f"FROM {table}"
        for c, _ in columns(table)
    )


@query(
    "agg_null_percentage",
    "SELECT table_name, column_name, round(null_share, 6) AS null_share FROM ("
    + _null_sql("events", lambda c: f"CASE WHEN event_type <> 'view' OR '{c}' = 'event_type' THEN {c} END")
    + " UNION ALL " + _null_sql("orders", lambda c: c) + ")",
)
def agg_null_percentage(spark, sf):
    events = load(spark, sf, "events")
    gaps = events.select(*[
        F.col(c) if c == "event_type" else F.when(F.col("event_type") != "view", F.col(c)).alias(c) for c in events.columns
    ])
    shares = profiling.null_percentages(gaps, "events").unionByName(profiling.null_percentages(tables.load_counted(spark, sf, "orders"), "orders"))
    return shares.withColumn("null_share", F.round("null_share", 6))


# Patterns whose meaning differs in an engine without look-around, or whose word
# edges are plain ASCII there: the same condition written without either.
_EDGE, _EDGE_END = r"(?:^|[^\p{L}\p{Nd}\p{Mn}_])", r"(?:$|[^\p{L}\p{Nd}\p{Mn}_])"
PLAIN_PATTERNS = {
    "STATE": _EDGE + "[A-Z]{2}" + _EDGE_END,
    "SOCIAL_SECURITY_NUMBER": (
        "(?:00[1-9]|0[1-9][0-9]|[1-57-8][0-9]{2}|6(?:[0-57-9][0-9]|6[0-57-9]))-?(?:0[1-9]|[1-9][0-9])-?"
        "(?:000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})"
    ),
}


def data_hits_sql(sources):
    """Match counts of every pattern over (table, column, FROM clause) sources."""
    parts = []
    for table, column, source in sources:
        for j, (name, pattern, score) in enumerate(DATA_PATTERNS):
            plain = PLAIN_PATTERNS.get(name, pattern)
            parts.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, {j} AS rule_no, '{name}' AS class_name, "
                f"count({column}) AS value_count, count(*) FILTER (regexp_matches({column}, {text(plain)})) AS match_count, "
                f"coalesce({score}::DOUBLE * count(*) FILTER (regexp_matches({column}, {text(plain)})) / nullif(count({column}), 0), 0.0) AS score "
                f"FROM {source}"
            )
    return " UNION ALL ".join(parts)


def text_sources(*names):
    return [(t, c, t) for t in names for c, kind in columns(t) if kind == "STRING"]


@query(
    "agg_pattern_match_ratio",
    f"SELECT * REPLACE (round(score, 6) AS score) FROM ({data_hits_sql(text_sources('documents', 'conversations', 'pages'))})",
)
def agg_pattern_match_ratio(spark, sf):
    out = None
    for name in ("documents", "conversations", "pages"):
        part = profiling.pattern_matches(load(spark, sf, name), name)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("score", F.round("score", 6))


@query(
    "agg_field_totals",
    f"SELECT table_name, field_count, sum(field_count) OVER (ORDER BY table_name)::BIGINT AS running_total, value_count FROM "
    f"(SELECT table_name, count(*) AS field_count, sum(value_count)::BIGINT AS value_count FROM ({catalog_sql()}) GROUP BY table_name)",
)
def agg_field_totals(spark, sf):
    return catalog.field_totals(stored_catalog(spark, sf).where("table_type <> 'VIEW'"))


def best_sql(hits: str, threshold: float) -> str:
    return (
        f"SELECT table_name, column_name, class_name, score FROM ({hits}) WHERE score >= {threshold} "
        f"QUALIFY row_number() OVER (PARTITION BY table_name, column_name ORDER BY score DESC, rule_no) = 1"
    )


@query(
    "agg_best_classification",
    "SELECT * REPLACE (round(score, 6) AS score) FROM (" + best_sql(data_hits_sql(text_sources("documents", "conversations")), 0.001) + ")",
)
def agg_best_classification(spark, sf):
    hits = profiling.pattern_matches(load(spark, sf, "documents"), "documents").unionByName(
        profiling.pattern_matches(load(spark, sf, "conversations"), "conversations")
    )
    return profiling.best_class(hits, threshold=0.001).withColumn("score", F.round("score", 6))


@query(
    "agg_collect_array",
    "SELECT conv_id, part, count(*)::INT AS n_turns, string_agg(role, ',' ORDER BY turn) AS roles, "
    "md5(string_agg(text, '|' ORDER BY turn)) AS text_mark "
    "FROM (SELECT *, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 10000)::BIGINT AS part FROM conversations) "
    "GROUP BY conv_id, part",
)
def agg_collect_array(spark, sf):
    parts = keys.collect_in_parts(load(spark, sf, "conversations"), ["conv_id"], ["turn"], ["role", "text"], "turns")
    return parts.select(
        "conv_id", "part", F.size("turns").alias("n_turns"), F.array_join("turns.role", ",").alias("roles"),
        F.md5(F.array_join("turns.text", "|")).alias("text_mark"),
    )
