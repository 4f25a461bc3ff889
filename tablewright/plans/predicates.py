"""Projections, filters and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.casting import merge_records
from tablewright.operators.filters import flag, typed_filter
from tablewright.operators.joins import in_list, not_in_list
from tablewright.plans.registry import query
from tablewright.sources import tables
from tablewright.sources.tables import load

query("project_fields", "SELECT c_custkey, c_mktsegment FROM customer")(
    lambda spark, sf: tables.keep_columns(load(spark, sf, "customer"), ["c_custkey", "c_mktsegment"])
)

query("project_except", "SELECT * EXCLUDE (c_acctbal) FROM customer")(
    lambda spark, sf: load(spark, sf, "customer").drop("c_acctbal")
)


@query("project_nested_path", "SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer")
def project_nested_path(spark, sf):
    nested = load(spark, sf, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("nation")).alias("home")).alias("who")
    )
    return nested.select("c_custkey", F.col("who.name").alias("name"), F.col("who.home.nation").alias("nation"))


@query("rebuild_record", "SELECT c_name AS my_name, c_acctbal AS balance, 'copied' AS origin FROM customer")
def rebuild_record(spark, sf):
    return load(spark, sf, "customer").select(
        F.col("c_name").alias("my_name"), F.col("c_acctbal").alias("balance"), F.lit("copied").alias("origin")
    )


@query(
    "merge_records_override",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 1000 THEN o_orderpriority END AS o_orderpriority, "
    "'X' AS o_orderstatus, o_totalprice FROM orders",
)
def merge_records_override(spark, sf):
    orders = load(spark, sf, "orders")
    base = {c: F.col(c) for c in ("o_orderkey", "o_orderpriority", "o_orderstatus")}
    later = {
        "O_ORDERPRIORITY": F.when(F.col("o_totalprice") > 1000, F.col("o_orderpriority")),
        "O_OrderStatus": F.lit("X"),
        "o_totalprice": F.col("o_totalprice"),
    }
    return merge_records(orders, [base, later], ignore_case=True)


query(
    "filter_expression",
    "SELECT event_id, event_type, value FROM events WHERE event_type = 'click' AND value > 10 AND props IS NOT NULL",
)(
    lambda spark, sf: tables.read_table(
        spark, sf, "events", ["event_id", "event_type", "value"], "event_type = 'click' and value > 10 and props is not null"
    )
)


@query(
    "filter_typed_params",
    "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000 "
    "AND o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'",
)
def filter_typed_params(spark, sf):
    orders = load(spark, sf, "orders")
    params = [("o_orderstatus", "F"), ("o_totalprice", "1000"), ("o_orderdate", "1995-01-01 00:00:00")]
    rows = typed_filter(orders, "o_orderstatus = ? and o_totalprice > ? and o_orderdate >= ?", params)
    return rows.select("o_orderkey", "o_totalprice", "o_orderdate")


@query(
    "filter_inlined_params",
    "SELECT doc_id, lang FROM documents WHERE (text LIKE '%it''s%' OR source <> '50% and $100 C:\\temp\\file') "
    "AND lang = 'en'",
)
def filter_inlined_params(spark, sf):
    params = [("text", "%it's%"), ("source", "50% and $100 C:\\temp\\file"), ("lang", "en")]
    rows = typed_filter(load(spark, sf, "documents"), "(text like ? or source <> ?) and lang = ?", params)
    return rows.select("doc_id", "lang")


@query(
    "filter_in_list",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R') "
    "AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
)
def filter_in_list(spark, sf):
    short = in_list(load(spark, sf, "lineitem"), "l_returnflag", ["A", "R"])
    good = load(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey")
    return in_list(short, "l_suppkey", good).select("l_orderkey", "l_linenumber", "l_returnflag")


@query(
    "filter_not_in_list",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag NOT IN ('N') "
    "AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
)
def filter_not_in_list(spark, sf):
    short = not_in_list(load(spark, sf, "lineitem"), "l_returnflag", ["N"])
    good = load(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey")
    return not_in_list(short, "l_suppkey", good).select("l_orderkey", "l_linenumber", "l_returnflag")


query("filter_not_equal_type", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")(
    lambda spark, sf: load(spark, sf, "orders").where(F.col("o_orderstatus") != F.lit("F")).select("o_orderkey", "o_orderstatus")
)


@query(
    "filter_date_threshold",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' ORDER BY ts, event_id LIMIT 1",
)
def filter_date_threshold(spark, sf):
    late = load(spark, sf, "events").where(F.col("ts") >= F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    return late.select("event_id", "ts").orderBy("ts", "event_id").limit(1)


@query("filter_not_null", "SELECT event_id, event_type FROM events WHERE event_type <> 'view'")
def filter_not_null(spark, sf):
    gaps = load(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type")
    )
    return gaps.where(F.col("event_type").isNotNull())


@query(
    "branch_default_if_empty",
    "SELECT conv_id, turn, CASE WHEN len(words) = 0 THEN ['none'] ELSE words END[1] AS first_word, "
    "greatest(len(words), 1)::INT AS n_words FROM (SELECT conv_id, turn, "
    "list_filter(string_split(text, ' '), lambda w: length(w) > 7) AS words FROM conversations)",
)
def branch_default_if_empty(spark, sf):
    words = F.filter(F.split("text", " "), lambda w: F.length(w) > 7)
    rows = load(spark, sf, "conversations").select("conv_id", "turn", words.alias("words"))
    filled = F.when(F.size("words") == 0, F.array(F.lit("none"))).otherwise(F.col("words"))
    return rows.select("conv_id", "turn", F.element_at(filled, 1).alias("first_word"), F.size(filled).alias("n_words"))


@query(
    "namespace_parameter",
    "SELECT '$projectId.orders' AS note, o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
)
def namespace_parameter(spark, sf):
    load(spark, sf, "orders").createOrReplaceGlobalTempView("orders")
    return tables.in_namespace(
        spark,
        "global_temp",
        "SELECT '$projectId.orders' AS note, o_orderstatus, count(*) AS n FROM IDENTIFIER(:ns || '.orders') GROUP BY o_orderstatus",
    )


@query(
    "filter_flag_logic",
    "SELECT lang, count(*) FILTER (q = 1) AS is_good, count(*) FILTER (q <> 1) AS not_good, "
    "count(*) FILTER (q::BOOLEAN AND NOT x::BOOLEAN) AS good_and_clean, count(*) FILTER (q::BOOLEAN OR x::BOOLEAN) AS either, "
    "count(*) FILTER ((q::BOOLEAN AND x::BOOLEAN) IS NULL) AS unknown "
    "FROM (SELECT d.lang, l.quality AS q, l.toxic AS x FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY lang",
)
def filter_flag_logic(spark, sf):
    rows = load(spark, sf, "documents").select("doc_id", "lang").join(load(spark, sf, "labels"), "doc_id", "left")
    good, toxic = flag(F.col("quality")), flag(F.col("toxic"))
    return rows.groupBy("lang").agg(
        F.count_if(F.col("quality") == 1).alias("is_good"),
        F.count_if(F.col("quality") != 1).alias("not_good"),
        F.count_if(good & ~toxic).alias("good_and_clean"),
        F.count_if(good | toxic).alias("either"),
        F.count_if((good & toxic).isNull()).alias("unknown"),
    )
