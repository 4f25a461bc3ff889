"""Value conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import casting, registered
from tablewright.functions.types import map_types, source_type
from tablewright.operators import changes, profiling
from tablewright.operators.profiling import infer_text_types
from tablewright.plans.reference_sql import catalog_sql, hash_pick
from tablewright.plans.registry import query
from tablewright.plans.tables import stored_catalog
from tablewright.session import scratch_path
from tablewright.sources import catalog
from tablewright.sources.tables import load


@query(
    "fn_cast_by_type_name",
    "SELECT o_orderkey, o_totalprice, o_orderdate, o_orderdate::DATE AS o_day, o_totalprice > 1000 AS large FROM orders",
)
def fn_cast_by_type_name(spark, sf):
    text = load(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), F.col("o_orderdate").cast("string"),
        casting.date_text(F.col("o_orderdate")).alias("o_day"), (F.col("o_totalprice") > 1000).cast("string").alias("large"),
    )
    kinds = {"o_orderkey": "integer", "o_totalprice": "FLOAT", "o_orderdate": "DateTime(6)", "o_day": "date", "large": "boolean"}
    return text.select(*[casting.from_text(F.col(c), kind).alias(c) for c, kind in kinds.items()])


@query(
    "fn_null_token",
    "SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS event_type FROM events",
)
def fn_null_token(spark, sf):
    spelled = F.when(F.col("event_type") == "click", F.lit("NuLL")).otherwise(F.col("event_type"))
    return load(spark, sf, "events").select("event_id", casting.null_token(spelled).alias("event_type"))


@query(
    "fn_write_cast",
    "SELECT event_id AS i, value AS f, event_id::VARCHAR AS s, event_id % 2 = 0 AS b, base64(event_type::BLOB) AS y, "
    "strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S.%f') AS t, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS dt, "
    "event_id::VARCHAR AS j, props AS js FROM events",
)
def fn_write_cast(spark, sf):
    events = load(spark, sf, "events").withColumn("even", F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"))
    wanted = [
        ("event_id", "INT64", "i"), ("value", "FLOAT64", "f"), ("event_id", "STRING", "s"), ("even", "BOOL", "b"),
        ("event_type", "BYTES", "y"), ("ts", "DATE", "d"), ("ts", "TIME", "t"), ("ts", "DATETIME", "dt"),
        ("event_id", "JSON", "j"), ("props", "JSON", "js"),
    ]
    return events.select(*[casting.write_value(F.col(c), events.schema[c].dataType, kind).alias(name) for c, kind, name in wanted])


@query(
    "fn_decimal_scale_class",
    "SELECT p_partkey, 'NUMERIC' AS short_class, p_retailprice::DECIMAL(18,2)::VARCHAR AS short_text, "
    "'BIGNUMERIC' AS long_class, (p_retailprice::DECIMAL(18,2))::DECIMAL(30,12)::VARCHAR AS long_text FROM part",
)
def fn_decimal_scale_class(spark, sf):
    part = load(spark, sf, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(18,2)").alias("short"))
    part = part.withColumn("long", F.col("short").cast("decimal(30,12)"))
    out = [F.col("p_partkey")]
    for c in ("short", "long"):
        out += [F.lit(casting.decimal_class(part.schema[c].dataType)).alias(f"{c}_class"),
                casting.plain_decimal(F.col(c)).alias(f"{c}_text")]
    return part.select(*out)


@query(
    "fn_format_timestamps",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS full_text, strftime(ts, '%H:%M:%S.%f') AS time_text, "
    "epoch_us(ts) AS micros FROM events",
)
def fn_format_timestamps(spark, sf):
    events = load(spark, sf, "events")
    ts, kind = F.col("ts"), events.schema["ts"].dataType
    return events.select(
        "event_id", casting.datetime_text(ts, kind).alias("full_text"),
        casting.time_text(ts, kind).alias("time_text"), casting.micros(ts).alias("micros"),
    )


@query(
    "fn_decode_epoch",
    "SELECT event_id, ts::DATE AS day, ts AS stamp, strftime(ts, '%H:%M:%S.%f') AS time_of_day FROM events",
)
def fn_decode_epoch(spark, sf):
    micros = casting.micros(F.col("ts"))
    day = 86_400_000_000
    raw = load(spark, sf, "events").select(
        "event_id", micros.alias("us"), F.floor(micros / day).alias("days"), (micros % day).alias("time_us")
    )
    return raw.select(
        "event_id", casting.from_epoch_days(F.col("days")).alias("day"),
        casting.from_epoch_micros(F.col("us")).alias("stamp"), casting.time_of_micros(F.col("time_us")).alias("time_of_day"),
    )


@query(
    "fn_format_interval",
    "SELECT l_orderkey, l_linenumber, format('{}{}-{} {}{} {}{}:{}:{:.3f}', CASE WHEN mo >= 0 THEN '+' ELSE '-' END, "
    "abs(mo) // 12, abs(mo) % 12, CASE WHEN dy >= 0 THEN '+' ELSE '-' END, abs(dy), "
    "CASE WHEN sg >= 0 THEN '+' ELSE '-' END, h, m, s::DOUBLE) AS span FROM (SELECT l_orderkey, l_linenumber, "
    "(l_quantity - 25)::BIGINT AS mo, (l_linenumber - 3)::BIGINT AS dy, CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS sg, "
    "l_partkey % 24 AS h, l_suppkey % 60 AS m, (l_orderkey % 60) + 0.25 AS s FROM lineitem)",
)
def fn_format_interval(spark, sf):
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1)
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        casting.interval_text(
            (F.col("l_quantity") - 25).cast("bigint"), (F.col("l_linenumber") - 3).cast("bigint"),
            sign * (F.col("l_partkey") % 24), sign * (F.col("l_suppkey") % 60), sign * ((F.col("l_orderkey") % 60) + 0.25),
        ).alias("span"),
    )


@query(
    "fn_array_convert",
    "SELECT vec_id, len(embedding)::INT AS n, round(list_sum([round(x::DOUBLE, 3) FOR x IN embedding]), 3) + 0.0 AS total, "
    "round(embedding[1]::DOUBLE, 3) + 0.0 AS first_value FROM embeddings",
)
def fn_array_convert(spark, sf):
    vectors = load(spark, sf, "embeddings")
    want = T.ArrayType(T.DoubleType())
    fitted = casting.fit(F.col("embedding"), vectors.schema["embedding"].dataType, want, "embedding", casting.strict)
    short = vectors.select("vec_id", F.transform(fitted, lambda v: F.round(v, 3)).alias("e"))
    return short.select(
        "vec_id", F.size("e").alias("n"), (F.round(F.aggregate("e", F.lit(0.0), lambda a, v: a + v), 3) + 0.0).alias("total"),
        (F.element_at("e", 1) + 0.0).alias("first_value"),
    )


@query(
    "fn_struct_convert",
    "SELECT c_custkey, c_nationkey::VARCHAR AS nation, c_acctbal AS balance, NULL::VARCHAR AS missing, 3 AS n_fields FROM customer",
)
def fn_struct_convert(spark, sf):
    raw = load(spark, sf, "customer").select(
        "c_custkey",
        F.struct(F.col("c_acctbal").cast("string").alias("balance"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("surplus")).alias("r"),
    )
    want = T.StructType([
        T.StructField("nation", T.StringType()), T.StructField("balance", T.DoubleType()), T.StructField("missing", T.StringType())
    ])
    fitted = casting.fit(F.col("r"), raw.schema["r"].dataType, want, "r", casting.strict)
    out = raw.select("c_custkey", fitted.alias("r"))
    return out.select("c_custkey", "r.*", F.lit(len(out.schema["r"].dataType.fields)).alias("n_fields"))


@query(
    "fn_json_encode",
    "SELECT event_id, props AS kept, '{\"user\":' || user_id || ',\"type\":\"' || event_type || '\"}' AS made, "
    "(props->>'$.k')::BIGINT AS k FROM events",
)
def fn_json_encode(spark, sf):
    events = load(spark, sf, "events").withColumn("r", F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")))
    kinds = {f.name: f.dataType for f in events.schema.fields}
    return events.select(
        "event_id", casting.json_text(F.col("props"), kinds["props"]).alias("kept"),
        casting.json_text(F.col("r"), kinds["r"]).alias("made"), F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


@query(
    "fn_range_bounds",
    "SELECT o_orderkey, o_orderdate AS low, o_orderdate + INTERVAL 7 DAY AS high, 'RANGE' AS kind FROM orders",
)
def fn_range_bounds(spark, sf):
    spans = load(spark, sf, "orders").select(
        "o_orderkey", F.struct(F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("end")).alias("span")
    )
    bounds = casting.range_bounds(F.col("span"))
    return spans.select(
        "o_orderkey", bounds[0].alias("low"), bounds[1].alias("high"), F.lit(source_type(spans.schema["span"].dataType)).alias("kind")
    )


@query(
    "infer_text_column_types",
    "SELECT 'o_orderkey' AS column_name, count(o_orderkey) AS value_count, 'INT64' AS inferred_type FROM orders "
    "UNION ALL SELECT 'o_custkey', count(o_custkey), 'INT64' FROM orders UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), 'STRING' FROM orders "
    "UNION ALL SELECT 'o_totalprice', count(o_totalprice), 'NUMERIC' FROM orders UNION ALL SELECT 'o_orderdate', count(o_orderdate), 'DATETIME' FROM orders "
    "UNION ALL SELECT 'o_orderpriority', count(o_orderpriority), 'STRING' FROM orders UNION ALL SELECT 'o_day', count(*), 'DATE' FROM orders "
    "UNION ALL SELECT 'large', count(*), 'BOOL' FROM orders",
)
def infer_text_column_types(spark, sf):
    orders = load(spark, sf, "orders")
    text = orders.select(
        *[F.col(c).cast("string") for c in orders.columns], casting.date_text(F.col("o_orderdate")).alias("o_day"),
        (F.col("o_totalprice") > 1000).cast("string").alias("large"),
    )
    return infer_text_types(text)


_NUMBERS = {
    "fine": "l_orderkey || '.' || lpad(l_partkey::VARCHAR, 13, '0') || '1'", "long_whole": "'9' || lpad(l_orderkey::VARCHAR, 24, '0')",
    "too_long": "'1' || lpad(l_orderkey::VARCHAR, 25, '0') || '.' || lpad(l_partkey::VARCHAR, 13, '0') || '7'", "rough": "l_partkey || 'e-3'",
    "mixed": "CASE WHEN l_linenumber = 1 THEN l_orderkey || '.25' ELSE l_orderkey::VARCHAR END",
}
_FOUND = {"fine": ("BIGNUMERIC", "decimal(38,14)"), "long_whole": ("NUMERIC", "decimal(38,9)"), "too_long": ("STRING", "string"),
          "rough": ("FLOAT64", "double"), "mixed": ("NUMERIC", "decimal(38,9)")}


@query(
    "infer_number_types",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({text}) AS value_count, '{_FOUND[c][0]}' AS inferred_type, '{_FOUND[c][1]}' AS spark_type, "
        f"count(DISTINCT {text}) AS distinct_values FROM lineitem" for c, text in _NUMBERS.items()
    ),
)
def infer_number_types(spark, sf):
    """Types from the merged states of two parts of a table; read as these, the columns keep every value apart."""
    lines = load(spark, sf, "lineitem").selectExpr(*[f"{text.replace('::VARCHAR', '::STRING')} AS {c}" for c, text in _NUMBERS.items()], "l_linenumber")
    first, rest = lines.where("l_linenumber = 1").drop("l_linenumber"), lines.where("l_linenumber <> 1").drop("l_linenumber")
    path = scratch_path(spark, "states")  # stored, as the types are read up front and again for the result
    changes.publish(profiling.merge_text_states(profiling.text_state(first).unionByName(profiling.text_state(rest))), path)
    states = changes.open_table(spark, path)
    typed = profiling.typed_texts(lines.drop("l_linenumber"), states)
    distinct = typed.agg(*[F.count_distinct(c).alias(c) for c in _NUMBERS]).unpivot([], list(_NUMBERS), "column_name", "distinct_values")
    found = profiling.text_types(states).select("column_name", F.col("values").alias("value_count"), "inferred_type", "spark_type")
    return found.join(distinct, "column_name")


query("fn_string_format", "SELECT c_custkey, 'baby_' || c_custkey AS name, c_name || ' (' || c_mktsegment || ')' AS label FROM customer")(
    lambda spark, sf: load(spark, sf, "customer").select(
        "c_custkey", F.format_string("baby_%s", "c_custkey").alias("name"),
        F.format_string("%s (%s)", "c_name", "c_mktsegment").alias("label"),
    )
)


@query(
    "fn_entity_id_cast",
    "SELECT o_orderkey AS as_integer, o_orderkey::DOUBLE AS as_real, o_orderkey::VARCHAR AS as_text, "
    "hex(o_orderkey::VARCHAR) AS as_blob, o_orderdate AS as_date, o_orderkey::VARCHAR AS as_other FROM orders",
)
def fn_entity_id_cast(spark, sf):
    key = F.col("o_orderkey").cast("string")
    return load(spark, sf, "orders").select(
        casting.entity_id(key, "integer").alias("as_integer"), casting.entity_id(key, "REAL").alias("as_real"),
        casting.entity_id(F.col("o_orderkey"), "TEXT").alias("as_text"), F.hex(casting.entity_id(key, "BLOB")).alias("as_blob"),
        casting.entity_id(F.col("o_orderdate").cast("string"), "DATETIME").alias("as_date"), casting.entity_id(key, "OTHER").alias("as_other"),
    )


@query(
    "fn_type_mapping",
    f"SELECT lower(source_type) AS source_type, CASE source_type WHEN 'INT64' THEN -5 WHEN 'FLOAT64' THEN 8 WHEN 'DATETIME' THEN 93 ELSE 12 END AS sql_code, "
    f"CASE source_type WHEN 'INT64' THEN 'BIGINT' WHEN 'FLOAT64' THEN 'DOUBLE' WHEN 'DATETIME' THEN 'TIMESTAMP' ELSE 'VARCHAR' END AS sql_name, "
    f"CASE source_type WHEN 'INT64' THEN 'INTEGER' WHEN 'FLOAT64' THEN 'REAL' WHEN 'DATETIME' THEN 'DATETIME' WHEN 'STRING' THEN 'STRING' ELSE 'UNKNOWN' END AS logical_class, "
    f"CASE source_type WHEN 'INT64' THEN 'integer' WHEN 'FLOAT64' THEN 'real' WHEN 'DATETIME' THEN 'string' WHEN 'STRING' THEN 'string' ELSE 'array' END AS primitive, "
    f"n_fields, n_values FROM (SELECT source_type, count(*) AS n_fields, sum(value_count)::BIGINT AS n_values FROM ({catalog_sql()}) GROUP BY source_type)",
)
def fn_type_mapping(spark, sf):
    fields = stored_catalog(spark, sf).where("table_type <> 'VIEW'")
    kinds = fields.groupBy(F.lower("source_type").alias("source_type")).agg(
        F.count("*").alias("n_fields"), F.sum("value_count").alias("n_values")
    )
    return map_types(kinds)


@query(
    "udf_named_functions",
    "SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS kind, event_id AS id, value AS amount, "
    "event_id AS entity, " + hash_pick("greek", "event_type", ["alpha", "beta", "gamma"]) + " AS picked, "
    "'+' || (event_id % 30) // 12 || '-' || (event_id % 30) % 12 || ' +' || (event_id % 7) || ' +' || (event_id % 9000) // 3600 || ':' || "
    "(event_id % 9000) % 3600 // 60 || ':' || (event_id % 9000) % 60 || '.000' AS span FROM events",
)
def udf_named_functions(spark, sf):
    registered.register_functions(spark)
    load(spark, sf, "events").createOrReplaceTempView("events")
    return spark.sql(
        "SELECT event_id, tw_null_token(if(event_type = 'click', 'null', event_type)) AS kind, "
        "tw_to_int64(cast(event_id AS STRING)) AS id, tw_to_float64(cast(value AS STRING)) AS amount, "
        "tw_entity_id(cast(event_id AS STRING)) AS entity, tw_pick('greek', event_type, array('alpha', 'beta', 'gamma')) AS picked, "
        "tw_interval(event_id % 30, event_id % 7, event_id % 9000) AS span FROM events"
    )


@query(
    "udf_inline_script",
    "SELECT o_orderkey, 'select ' || o_orderkey || ' where status = ''' || o_orderstatus || '''' AS statement, "
    "o_totalprice > 1000 AND o_orderstatus = 'F' AS instance_found, CASE WHEN o_totalprice > 1000 THEN 1 ELSE 0 END AS counter FROM orders",
)
def udf_inline_script(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", F.expr("concat('select ', o_orderkey, ' where status = \\'', o_orderstatus, '\\'')").alias("statement"),
        F.expr("o_totalprice > 1000 and o_orderstatus = 'F'").alias("instance_found"),
        F.expr("case when o_totalprice > 1000 then 1 else 0 end").alias("counter"),
    )
