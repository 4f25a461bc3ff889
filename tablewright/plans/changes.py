"""Writes: every query writes to the shared folder and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import changes, versions
from tablewright.plans.registry import query
from tablewright.session import scratch_path
from tablewright.sources.tables import load

ORDER_TOTALS = (
    "SELECT o_orderstatus, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total, min(o_orderdate) AS first_date, "
    "sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY o_orderstatus"
)


def order_totals(df):
    return df.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").alias("first_date"), F.sum("o_orderkey").alias("key_sum"),
    )


@query("append_batched_default", ORDER_TOTALS)
def append_batched_default(spark, sf):
    path = scratch_path(spark, "append")
    changes.append(load(spark, sf, "orders"), path)
    return order_totals(spark.read.parquet(path))


@query("publish_atomic_pending", ORDER_TOTALS)
def publish_atomic_pending(spark, sf):
    path = scratch_path(spark, "publish")
    orders = load(spark, sf, "orders")
    changes.publish(orders.where("o_orderstatus = 'F'"), path)
    changes.publish_more(orders.where("o_orderstatus <> 'F'"), path)
    return order_totals(changes.open_table(spark, path))


@query(
    "schema_enforced_write",
    "SELECT event_id, ts, user_id, event_type, value, props, NULL::VARCHAR AS note FROM events",
)
def schema_enforced_write(spark, sf):
    events = load(spark, sf, "events")
    path = scratch_path(spark, "enforced")
    target = T.StructType([*events.schema.fields, T.StructField("note", T.StringType())])
    changes.write_enforced(events.select(*[F.col(c).cast("string") for c in reversed(events.columns)]), target, path)
    return changes.open_table(spark, path)


@query(
    "delete_all_rows",
    "SELECT count(*) AS rows_removed, 0::BIGINT AS rows_left, 5::BIGINT AS columns_left FROM customer",
)
def delete_all_rows(spark, sf):
    path = scratch_path(spark, "delete-all")
    changes.publish(load(spark, sf, "customer"), path)
    removed = changes.delete_all(spark, path)
    left = changes.open_table(spark, path)
    return left.agg(F.count("*").alias("rows_left")).select(
        F.lit(removed).cast("bigint").alias("rows_removed"), "rows_left",
        F.lit(len(left.columns)).cast("bigint").alias("columns_left"),
    )


@query("truncate_table", "SELECT 0::BIGINT AS rows_left, 6::BIGINT AS columns_left")
def truncate_table(spark, sf):
    path = scratch_path(spark, "truncate")
    changes.publish(load(spark, sf, "part"), path)
    changes.truncate(spark, path)
    left = changes.open_table(spark, path)
    return left.agg(F.count("*").alias("rows_left")).select(
        "rows_left", F.lit(len(left.columns)).cast("bigint").alias("columns_left")
    )


@query(
    "delete_by_keys",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT EXISTS "
    "(SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = l_orderkey)",
)
def delete_by_keys(spark, sf):
    path = scratch_path(spark, "delete-keys")
    changes.publish(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), path)
    gone = load(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    changes.delete_by_keys(spark, path, gone, ["l_orderkey"])
    return changes.open_table(spark, path)


@query(
    "delete_by_entity",
    "SELECT event_id, user_id FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS user_id "
    "FROM events) WHERE user_id IS DISTINCT FROM 7",
)
def delete_by_entity(spark, sf):
    path = scratch_path(spark, "delete-entity")
    gaps = load(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id"))
    changes.publish(gaps, path)
    changes.delete_by_entity(spark, path, "user_id", 7)
    return changes.open_table(spark, path)


@query(
    "upsert_by_keys",
    "SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END::DOUBLE AS c_acctbal FROM customer "
    "UNION ALL SELECT s_suppkey + 1000000000, s_name, s_acctbal FROM supplier",
)
def upsert_by_keys(spark, sf):
    path = scratch_path(spark, "upsert")
    customers = load(spark, sf, "customer")
    changes.publish(customers.select("c_custkey", "c_name", "c_acctbal"), path)
    zeroed = customers.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", F.lit(0.0).alias("c_acctbal"))
    new = load(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")
    )
    changes.upsert(spark, path, zeroed.unionByName(new), ["c_custkey"])
    return changes.open_table(spark, path)


@query(
    "compact_table",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE o_totalprice END AS o_totalprice "
    "FROM orders WHERE o_custkey % 10 <> 3",
)
def compact_table(spark, sf):
    """Rows that came in pieces, lost some keys, had others replaced, and were joined into few files."""
    path = scratch_path(spark, "compact")
    orders = load(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    for status in ("F", "O", "P"):
        changes.publish_more(orders.where(F.col("o_orderstatus") == status).select(*columns), path)
    changes.delete_by_keys(spark, path, orders.where("o_custkey % 10 = 3").select("o_orderkey"), ["o_orderkey"])
    urgent = orders.where("o_orderpriority = '1-URGENT' AND o_custkey % 10 <> 3")
    changes.upsert(spark, path, urgent.withColumn("o_totalprice", F.lit(0.0)).select(*columns), ["o_orderkey"])
    versions.compact(spark, path)
    versions.drop_old_versions(spark, path)
    return changes.open_table(spark, path)


@query(
    "copy_table",
    "SELECT p_partkey AS part_key, upper(p_name) AS part_name, p_retailprice AS price, 'copy' AS origin FROM part",
)
def copy_table(spark, sf):
    path = scratch_path(spark, "copy")
    rows = load(spark, sf, "part").select(
        F.col("p_partkey").alias("part_key"), F.upper("p_name").alias("part_name"),
        F.col("p_retailprice").alias("price"), F.lit("copy").alias("origin"),
    )
    changes.publish(rows, path)
    return changes.open_table(spark, path)


LEVELS = (("region",), ("nation",), ("customer", "supplier", "part"), ("orders",), ("lineitem",))


def _status_sql(levels, reverse=False):
    rows = reversed(levels) if reverse else levels
    return " UNION ALL ".join(
        f"SELECT {i} AS level, '{t}' AS table_name, 'done' AS status, count(*) AS row_count FROM {t}"
        for i, level in enumerate(rows)
        for t in level
    )


def _load_levels(spark, sf):
    path = scratch_path(spark, "levels")
    return path, changes.load_by_level(spark, [{t: load(spark, sf, t) for t in level} for level in LEVELS], path)


@query("load_tables_by_level", _status_sql(LEVELS))
def load_tables_by_level(spark, sf):
    return _load_levels(spark, sf)[1].drop("message")


@query("delete_tables_by_level", _status_sql(LEVELS, reverse=True))
def delete_tables_by_level(spark, sf):
    path, _ = _load_levels(spark, sf)
    return changes.delete_by_level(spark, list(reversed(LEVELS)), path).drop("message")


@query(
    "load_with_error_rows",
    "SELECT event_id, 'loaded' AS outcome, try_cast(v AS DOUBLE) AS number, NULL AS column_name, NULL AS raw_value "
    "FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN props ELSE value::VARCHAR END AS v FROM events) "
    "WHERE try_cast(v AS DOUBLE) IS NOT NULL OR v IS NULL UNION ALL "
    "SELECT event_id, 'error', NULL, 'v', v FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN props "
    "ELSE value::VARCHAR END AS v FROM events) WHERE try_cast(v AS DOUBLE) IS NULL AND v IS NOT NULL",
)
def load_with_error_rows(spark, sf):
    mixed = load(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "view", F.col("props")).otherwise(F.col("value").cast("string")).alias("v")
    )
    target = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("v", T.DoubleType())])
    good_path, error_path = scratch_path(spark, "good"), scratch_path(spark, "errors")
    changes.load_with_errors(mixed, target, good_path, error_path)
    good = changes.open_table(spark, good_path).select(
        "event_id", F.lit("loaded").alias("outcome"), F.col("v").alias("number"),
        F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("raw_value"),
    )
    bad = changes.open_table(spark, error_path).select(
        F.get_json_object("row_json", "$.event_id").cast("bigint").alias("event_id"), F.lit("error").alias("outcome"),
        F.lit(None).cast("double").alias("number"), "column_name", "raw_value",
    )
    return good.unionByName(bad)


_MIXED = (
    "(SELECT user_id, CASE WHEN event_type = 'purchase' AND event_id % 40 = 0 THEN props ELSE value::VARCHAR END AS v FROM events)"
)


@query(
    "load_failed_entities",
    f"SELECT user_id::VARCHAR AS entity, count(*) AS row_count, count(*) FILTER (v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL) AS failed_rows, "
    f"CASE WHEN count(*) FILTER (v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL) > 0 THEN 'failed' ELSE 'loaded' END AS outcome, "
    f"CASE WHEN count(*) FILTER (v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL) > 0 THEN 0 ELSE count(*) END AS rows_loaded "
    f"FROM {_MIXED} GROUP BY user_id",
)
def load_failed_entities(spark, sf):
    odd = (F.col("event_type") == "purchase") & (F.col("event_id") % 40 == 0)
    mixed = load(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), F.when(odd, F.col("props")).otherwise(F.col("value").cast("string")).alias("v")
    )
    target = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("v", T.DoubleType())])
    good, _, outcomes = changes.split_entities(mixed, target, "user_id")
    path = scratch_path(spark, "entities")
    changes.publish(good, path)
    stored = changes.open_table(spark, path).groupBy(F.col("user_id").cast("string").alias("entity")).agg(F.count("*").alias("rows_loaded"))
    return outcomes.join(stored, "entity", "left").select(
        *outcomes.columns, F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded")
    )


@query(
    "load_statistics",
    "SELECT 'orders' AS table_name, count(*) AS rows_read, count(*) FILTER (o_orderstatus <> 'P') AS rows_written FROM orders "
    "UNION ALL SELECT 'supplier', count(*), count(*) FROM supplier",
)
def load_statistics(spark, sf):
    pairs = {}
    for name, where in (("orders", "o_orderstatus <> 'P'"), ("supplier", "true")):
        path = scratch_path(spark, "stats")
        read = load(spark, sf, name)
        changes.publish(read.where(where), path)
        pairs[name] = (read, changes.open_table(spark, path))
    return changes.load_statistics(pairs)


@query(
    "rows_affected",
    "SELECT 'update' AS statement, count(*) AS rows_affected FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) "
    "UNION ALL SELECT 'insert', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) "
    "UNION ALL SELECT 'delete', count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) "
    "UNION ALL SELECT 'query', -1",
)
def rows_affected(spark, sf):
    source = load(spark, sf, "customer")
    target = load(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return changes.change_counts(target, source, ["c_custkey"])
