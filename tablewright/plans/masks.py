"""Masking, re-keying, generating and whole-entity jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import changes, entities, generating, masking, profiling
from tablewright.operators.joins import child_rows
from tablewright.plans import reference_sql as ref
from tablewright.plans.registry import query
from tablewright.plans.tables import task_settings
from tablewright.rules.generators import BY_CLASS, GENERATORS
from tablewright.session import scratch_path
from tablewright.sources import catalog
from tablewright.sources.tables import load, row_counts

FIRST_NAMES = ("Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gus")
LAST_NAMES = ("Archer", "Baker", "Cook", "Dyer", "Fisher")


@query(
    "mask_with_collection",
    f"SELECT c_custkey, {ref.hash_pick('name', 'c_name', FIRST_NAMES)} AS c_name FROM customer",
)
def mask_with_collection(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", masking.mask_from(F.col("c_name"), "name", FIRST_NAMES).alias("c_name"))


_MAIL = f"lower({ref.hash_pick('first', 'c_name', FIRST_NAMES)} || '.' || {ref.hash_pick('last', 'c_name', LAST_NAMES)} || '@example.com')"


@query("mask_email", f"SELECT c_custkey, {_MAIL} AS email FROM customer")
def mask_email(spark, sf):
    first = masking.mask_from(F.col("c_name"), "first", FIRST_NAMES)
    last = masking.mask_from(F.col("c_name"), "last", LAST_NAMES)
    return load(spark, sf, "customer").select("c_custkey", masking.mask_email(first, last).alias("email"))


def _people(spark, sf):
    """Customers under column names that tell their class."""
    return load(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("full_name"), F.concat("c_name", F.lit("@mail.example")).alias("email"),
        F.col("c_mktsegment").alias("gender"), F.col("c_nationkey").alias("age"), "c_acctbal",
    )


# The e-mail of a number: last the ending, before it the domain, before that the name; shorter ones first, the last letter fastest.
_NAME = "abcdefghijklmnopqrstuvwxyz0123456789."
_EMAIL = (
    f"(SELECT {ref.spelled('n // 3 // %d' % sum(27**k for k in range(4, 11)), _NAME, 6, 7)} || '@' || "
    f"{ref.spelled('(n // 3) %% %d' % sum(27**k for k in range(4, 11)), 'abcdefghijklmnopqrstuvwxyz.', 4, 10)} || '.' || "
    f"['com', 'net', 'org'][n % 3 + 1])"
)


@query(
    "mask_by_catalog",
    f"SELECT c_custkey, {ref.hash_letters('FULL_NAME', 'c_name', 10, 20)} AS full_name, "
    f"{_EMAIL} AS email, "
    f"{ref.hash_pick('gender', 'c_custkey', ['Male', 'Female'])} AS gender, "
    f"{ref.hash_range('age', 'c_custkey', 0, 18, 99)}::INT AS age, c_acctbal FROM customer "
    f"JOIN (SELECT c_name AS m, row_number() OVER (ORDER BY "
    + ref.hash_hex("EMAIL", "c_name || '@mail.example'", 0)
    + ", c_name || '@mail.example') - 1 AS n FROM (SELECT DISTINCT c_name FROM customer)) ON m = c_name",
)
def mask_by_catalog(spark, sf):
    people = _people(spark, sf)
    fields = catalog.crawl_table(people, "main", "people").select("table_name", "column_name")
    # one row per column of one table
    found = {r["column_name"]: r["class_name"] for r in profiling.classify_by_name(fields).collect()}
    return masking.mask_by_class(people, found, "c_custkey")


_ROOM = 99999999 - 10000000 + 1
_NEW = "SELECT k, {first} + row_number() OVER (ORDER BY " + ref.hash_hex("BANK_ACCOUNT", "k", 0) + ", k::VARCHAR) - 1 AS n FROM "


@query(
    "mask_two_tables",
    "WITH a AS (" + _NEW.format(first="0") + "(SELECT DISTINCT c_custkey AS k FROM customer)), "
    "b AS (" + _NEW.format(first="(SELECT count(*) FROM a)") + "(SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT k FROM a))), "
    f"m AS (SELECT k, 10000000 + {ref.permuted('n', _ROOM, 'BANK_ACCOUNT')} AS mask FROM (FROM a UNION ALL FROM b)) "
    "SELECT o_orderkey, mask AS account, c_name FROM orders JOIN m ON k = o_custkey LEFT JOIN customer ON c_custkey = o_custkey",
)
def mask_two_tables(spark, sf):
    """Two tables masked apart, one after the other, meet again on the masked key."""
    folder = scratch_path(spark, "masks")
    customers = load(spark, sf, "customer").select(F.col("c_custkey").alias("account"), "c_name")
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("account"))
    masked = masking.mask_by_class(customers, {"account": "BANK_ACCOUNT"}, "account", folder)
    others = masking.mask_by_class(orders, {"account": "BANK_ACCOUNT"}, "o_orderkey", folder)
    return others.join(masked, "account", "left").select("o_orderkey", "account", "c_name")


@query(
    "mask_sequence_replace",
    "WITH m AS (SELECT c_mktsegment AS s, c_custkey AS old, 100 + 10 * (row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1) AS new FROM customer) "
    "SELECT s AS instance, old AS source_value, new AS target_value FROM m",
)
def mask_sequence_replace(spark, sf):
    customers = load(spark, sf, "customer").withColumnRenamed("c_mktsegment", "instance")
    return masking.key_mapping([(customers, "c_custkey")], scope=["instance"], start=100, step=10)


@query(
    "mask_sequence_audit",
    "WITH m AS (SELECT k, row_number() OVER (ORDER BY k) AS n FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus <> 'P')) "
    "SELECT 'run-1' AS task_execution_id, 'customer' AS lu_type, 'cust_seq' AS seq_name, 'orders' AS table_name, "
    "'o_custkey' AS column_name, k::VARCHAR AS source_value, n::VARCHAR AS target_value FROM m",
)
def mask_sequence_audit(spark, sf):
    gaps = load(spark, sf, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    mapping = masking.extend_mapping(spark, scratch_path(spark, "sequence"), gaps, "o_custkey")
    path = scratch_path(spark, "audit")
    changes.publish(masking.audit_rows(gaps, mapping, "orders", "o_custkey", "cust_seq", "run-1", "customer"), path)
    return changes.open_table(spark, path)


@query(
    "mask_policy_switch",
    f"SELECT c_custkey, {ref.hash_letters('FULL_NAME', 'c_name', 10, 20)} AS full_name, c_name || '@mail.example' AS email, "
    f"c_mktsegment AS gender, c_nationkey AS age, c_acctbal FROM customer",
)
def mask_policy_switch(spark, sf):
    policy = spark.createDataFrame(
        [("people", "full_name", True), ("people", "email", False), ("other", "gender", True)],
        "table_name string, column_name string, enabled boolean",
    )
    classes = {"full_name": "FULL_NAME", "email": "EMAIL", "gender": "GENDER"}
    return masking.mask_with_policy(_people(spark, sf), "people", classes, policy, "c_custkey")


def pattern_sql(class_name: str, label: str, value: str) -> str:
    """Strings of the patterns in SQL: a pattern of few strings takes one draw, the e-mail one for each of its lengths and letters."""
    n = lambda draw, count: f"({ref.wide_number(label, value, draw)} % {count})"
    upper, lower, name = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz.", _NAME
    at = lambda items, place: f"substr('{items}', ({place} + 1)::INT, 1)"
    if class_name == "STATE":
        return f"(SELECT {at(upper, 'n // 26')} || {at(upper, 'n % 26')} FROM (SELECT {n(0, 676)} AS n))"
    if class_name == "TELEPHONE_NUMBER":
        return (
            f"(SELECT '+1 (' || (200 + n // 8000000) || ')-' || (200 + n // 10000 % 800) || '-' || lpad((n % 10000)::VARCHAR, 4, '0') "
            f"FROM (SELECT {n(0, 8 * 100 * 8 * 100 * 10000)} AS n))"
        )
    if class_name == "POSTAL_CODE":
        return (
            f"(SELECT lpad((n // 10001)::VARCHAR, 5, '0') || CASE WHEN n % 10001 = 0 THEN '' "
            f"ELSE '-' || lpad((n % 10001 - 1)::VARCHAR, 4, '0') END FROM (SELECT {n(0, 100000 * 10001)} AS n))"
        )
    if class_name == "IP_ADDRESS":
        return f"(SELECT (n >> 24) || '.' || ((n >> 16) & 255) || '.' || ((n >> 8) & 255) || '.' || (n & 255) FROM (SELECT {n(0, 2**32)} AS n))"
    if class_name == "MAC_ADDRESS":
        # five pairs with their mark, each 512 numbers, then the last pair
        pairs = [f"upper(lpad(to_hex(n // {256 * 512**k} // 2 % 256), 2, '0')) || [':', '-'][(n // {256 * 512**k} % 2 + 1)::INT]" for k in (4, 3, 2, 1, 0)]
        return f"(SELECT {' || '.join(pairs)} || upper(lpad(to_hex(n % 256), 2, '0')) FROM (SELECT {n(0, 512**5 * 256)} AS n))"
    if class_name == "DRIVER_LICENSE":
        figures = sum(10**k for k in range(1, 7))
        return (
            f"(SELECT {ref.spelled('n // 27 // %d' % figures, upper, 1, 2)} || {ref.spelled('n // 27 %% %d' % figures, '0123456789', 1, 6)} || "
            f"CASE WHEN n % 27 = 0 THEN '' ELSE {at(upper, 'n % 27 - 1')} END FROM (SELECT {n(0, 702 * figures * 27)} AS n))"
        )
    # an e-mail: a draw for the length of the name, then one for each eleven letters of a name of each length, then one for the rest
    draw, names = 1, []
    for length in range(6, 21):
        parts = [min(11, length)] + [length - 11] * (length > 11)
        letters = [ref.spelled(n(draw + i, len(name) ** k), name, k, k) for i, k in enumerate(parts)]
        names.append(f"WHEN {length - 6} THEN {' || '.join(letters)}")
        draw += len(parts)
    domains = sum(27**k for k in range(4, 11))
    return (
        f"(SELECT CASE {n(0, 15)} {' '.join(names)} END || '@' || {ref.spelled('(n // 3 %% %d)' % domains, lower, 4, 10)} || '.' || "
        f"['com', 'net', 'org'][(n % 3 + 1)::INT] FROM (SELECT {n(draw, domains * 3)} AS n))"
    )


def generated_sql(class_name: str, label: str, value: str) -> str:
    generator, s, _, _ = BY_CLASS[class_name]
    n = lambda k: ref.hash_number(label, value, k)
    if generator == "string":
        return ref.hash_letters(label, value, s["low"], s["high"])
    if generator == "number":
        return ref.hash_range(label, value, 0, s["low"], s["high"])
    if generator == "choice":
        return ref.hash_pick(label, value, s["items"])
    if generator == "credit_card":
        body = f"{ref.digits(label, value, 0, 8)} || {ref.digits(label, value, 1, 7)}"
        keep = s["prefix_length"]
        if keep:
            body = (
                f"CASE WHEN regexp_matches(({value})::VARCHAR, '^\\d{{{keep}}}') THEN substr(({value})::VARCHAR, 1, {keep}) || "
                f"substr({body}, {keep + 1}) ELSE {body} END"
            )
        return ref.check_digit(body)
    if generator == "ssn":
        part = lambda k, high, w: f"lpad((1 + {n(k)} % {high})::VARCHAR, {w}, '0')"
        return f"{part(0, 665, 3)} || '-' || {part(1, 99, 2)} || '-' || {part(2, 9999, 4)}"
    return pattern_sql(class_name, label, value)


@query(
    "generate_by_classification",
    "SELECT p_partkey, " + ", ".join(f"{generated_sql(c, c.lower(), 'p_partkey')} AS {c.lower()}" for c, *_ in GENERATORS) + " FROM part",
)
def generate_by_classification(spark, sf):
    made = [generating.generate_class(c, c.lower(), F.col("p_partkey")).alias(c.lower()) for c, *_ in GENERATORS]
    return load(spark, sf, "part").select("p_partkey", *made)


@query(
    "generate_type_defaults",
    f"SELECT o_orderkey AS row_id, ({ref.hash_number('event_id', 'o_orderkey', 0)} % 1000000)::BIGINT AS event_id, "
    f"TIMESTAMP '2000-01-01 00:00:00' + to_seconds({ref.hash_number('ts', 'o_orderkey', 0)} % 700000000) AS ts, "
    f"({ref.hash_number('user_id', 'o_orderkey', 0)} % 1000000)::BIGINT AS user_id, {ref.hash_letters('event_type', 'o_orderkey', 5, 15)} AS event_type, "
    f"({ref.hash_number('value', 'o_orderkey', 0)} % 1000000) / 100.0::DOUBLE AS value, {ref.hash_letters('props', 'o_orderkey', 5, 15)} AS props FROM orders",
)
def generate_type_defaults(spark, sf):
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"))
    return generating.generate_columns(rows, F.col("row_id"), load(spark, sf, "events").schema)


_SOURCE = "(o_custkey::VARCHAR || '-' || child_no::VARCHAR)"


@query(
    "generate_children",
    f"SELECT o_custkey, child_no, row_number() OVER (ORDER BY o_custkey, child_no) AS o_orderkey, "
    f"{ref.hash_letters('o_orderstatus', _SOURCE, 5, 15)} AS o_orderstatus, "
    f"({ref.hash_number('o_totalprice', _SOURCE, 0)} % 1000000) / 100.0::DOUBLE AS o_totalprice, "
    f"TIMESTAMP '2000-01-01 00:00:00' + to_seconds({ref.hash_number('o_orderdate', _SOURCE, 0)} % 700000000) AS o_orderdate, "
    f"{generated_sql('LANGUAGE', 'o_orderpriority', _SOURCE)} AS o_orderpriority "
    f"FROM (SELECT c_custkey AS o_custkey, n::INT AS child_no FROM customer, (SELECT unnest([1, 2, 3]) AS n))",
)
def generate_children(spark, sf):
    return generating.generate_children(
        load(spark, sf, "customer"), {"c_custkey": "o_custkey"}, 3, load(spark, sf, "orders").schema,
        sequence="o_orderkey", classes={"o_orderpriority": "LANGUAGE"},
    )


@query(
    "transform_read_mask_write",
    f"SELECT o_orderkey, {ref.hash_pick('o_orderpriority', 'o_orderpriority', FIRST_NAMES)} AS my_name, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def transform_read_mask_write(spark, sf):
    path = scratch_path(spark, "masked")
    entities.mask_and_copy(
        load(spark, sf, "orders"), ["o_orderkey", "o_orderpriority", "o_totalprice"], "o_orderstatus = 'F'",
        "o_orderpriority", FIRST_NAMES, {"o_orderpriority": "my_name"}, path,
    )
    return changes.open_table(spark, path)


@query(
    "document_assemble",
    "SELECT o_orderkey, o_custkey, coalesce(part, 0)::BIGINT AS part, count(l_orderkey)::INT AS n_lines, coalesce(sum(l_partkey), 0)::BIGINT AS part_sum, "
    "coalesce(string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber), '') AS line_numbers "
    "FROM orders LEFT JOIN (SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1) // 10000 AS part FROM lineitem) "
    "ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, part",
)
def document_assemble(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    docs = entities.assemble(
        load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", {"lines": (lines, "l_orderkey", ["l_linenumber"])}
    )
    return docs.select(
        "o_orderkey", "o_custkey", "part", F.size("lines").alias("n_lines"),
        F.aggregate("lines.l_partkey", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("part_sum"),
        F.array_join(F.transform("lines.l_linenumber", lambda v: v.cast("string")), ",").alias("line_numbers"),
    )


_FLAGS = "c_mktsegment IN ('BUILDING', 'MACHINERY') AS sync, c_nationkey < 20 AS known, c_mktsegment = 'FURNITURE' AS delete_only"


@query(
    "extract_sync_policy",
    f"WITH f AS (SELECT c_custkey AS entity, {_FLAGS} FROM customer), "
    f"o AS (SELECT *, CASE WHEN sync THEN 'reload' WHEN NOT known AND NOT delete_only THEN 'failed' ELSE 'keep' END AS outcome FROM f), "
    f"t AS (SELECT o_orderkey, o_custkey, 0.0::DOUBLE AS o_totalprice FROM orders JOIN f ON entity = o_custkey WHERE known), "
    f"r AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders JOIN o ON entity = o_custkey WHERE outcome = 'reload' "
    f"UNION ALL SELECT t.* FROM t JOIN o ON entity = o_custkey WHERE outcome <> 'reload') "
    f"SELECT o.outcome, count(DISTINCT entity) AS entities, count(r.o_orderkey) AS order_rows, round(coalesce(sum(o_totalprice), 0), 2) AS total "
    f"FROM o LEFT JOIN r ON r.o_custkey = entity GROUP BY o.outcome",
)
def extract_sync_policy(spark, sf):
    segment = F.col("c_mktsegment")
    flags = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity"), segment.isin("BUILDING", "MACHINERY").alias("sync"),
        (F.col("c_nationkey") < 20).alias("known"), (segment == "FURNITURE").alias("delete_only"),
    )
    outcomes = entities.sync_outcomes(flags)
    source = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    stored = child_rows(source.withColumn("o_totalprice", F.lit(0.0)), flags.where("known"), "o_custkey", "entity")
    path = scratch_path(spark, "sync")
    changes.publish(entities.sync_rows(outcomes, source, stored.select(source.columns), "o_custkey").select(source.columns), path)
    rows = changes.open_table(spark, path)
    per_entity = rows.groupBy(F.col("o_custkey").alias("entity")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("t"))
    return outcomes.join(per_entity, "entity", "left").groupBy("outcome").agg(
        F.count("*").alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("order_rows"),
        F.round(F.coalesce(F.sum("t"), F.lit(0.0)), 2).alias("total"),
    )


_WHERE = ("l_quantity >= ?", [("l_quantity", "20")])


def _task(spark):
    """The steps of ``lineitem`` as its settings row names them."""
    return entities.tasks_from(spark, ["lineitem"], task_settings(spark), filters={"lineitem": _WHERE})[0][2]


@query("extract_table", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 20")
def extract_table(spark, sf):
    return entities.extract_rows(load(spark, sf, "lineitem"), _task(spark)).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "load_table",
    "SELECT l_returnflag, count(*) AS n_rows, round(sum(l_quantity), 2) AS quantity FROM lineitem WHERE l_quantity >= 20 GROUP BY l_returnflag",
)
def load_table(spark, sf):
    path, lines = scratch_path(spark, "task"), load(spark, sf, "lineitem")
    changes.publish(lines.where("l_linenumber = 1"), f"{path}/lineitem")
    settings = task_settings(spark).withColumn("delete_step", F.lit("delete_all"))
    entities.run_tasks(spark, {"lineitem": lines}, settings, path, filters={"lineitem": _WHERE})
    return entities.open_loaded(spark, f"{path}/lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "run_task_table",
    "SELECT 0 AS level, 'customer' AS table_name, 'done' AS status, count(*) AS row_count, count(*) AS stored FROM customer UNION ALL "
    "SELECT 0, 'events', 'done', count(*) FILTER (event_type = 'view'), count(*) FILTER (event_type = 'view') FROM events UNION ALL "
    "SELECT 1, 'lineitem', 'done', count(*) FILTER (l_quantity >= 20), count(*) FILTER (l_quantity >= 20) FROM lineitem",
)
def run_task_table(spark, sf):
    """Three tables run by their settings: two of the first level, one by the default row, and one after them."""
    path = scratch_path(spark, "tasks")
    frames = {name: load(spark, sf, name) for name in ("lineitem", "events", "customer")}
    filters = {"lineitem": _WHERE, "events": ("event_type = 'view'", [])}
    status = entities.run_tasks(spark, frames, task_settings(spark), path, filters=filters).drop("message")
    stored = row_counts({name: entities.open_loaded(spark, f"{path}/{name}") for name in frames}).withColumnRenamed("row_count", "stored")
    return status.join(stored, "table_name")


@query("record_count", "SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem WHERE l_quantity >= 20")
def record_count(spark, sf):
    return row_counts({"lineitem": entities.extract_rows(load(spark, sf, "lineitem"), _task(spark))})


@query(
    "mask_sequence_scoped",
    "SELECT c_mktsegment AS instance, c_custkey AS source_value, 100 + 10 * (row_number() OVER (PARTITION BY c_mktsegment "
    "ORDER BY c_custkey % 2, c_custkey) - 1) AS target_value FROM customer",
)
def mask_sequence_scoped(spark, sf):
    """Two runs on one stored sequence, numbered apart in each segment: even keys first, then all keys."""
    path = scratch_path(spark, "sequence")
    customers = load(spark, sf, "customer").withColumnRenamed("c_mktsegment", "instance")
    masking.extend_mapping(spark, path, customers.where("c_custkey % 2 = 0"), "c_custkey", 100, 10, scope=["instance"])
    return masking.extend_mapping(spark, path, customers, "c_custkey", 100, 10, scope=["instance"])
