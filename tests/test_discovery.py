import re

import pytest
from pyspark.sql import functions as F

from tablewright.operators import joins, profiling
from tablewright.rules.patterns import DATA_PATTERNS, NAME_PATTERNS, PERSONAL_CLASSES
from tablewright.sources import catalog


def by_path(df):
    return {r.field_path: r for r in df.collect()}


def test_nested_records(spark):
    df = spark.createDataFrame(
        [(1, ("s", (1.5,))), (2, (None, None)), (3, None)], "id long, address struct<street:string,geo:struct<lat:double>>"
    )
    found = by_path(catalog.crawl({"people": df}, "main"))
    assert {p: (r.ordinal, r.top_level, r.defined_by) for p, r in found.items()} == {
        "id": (0, True, "INTEGER"), "address": (1, True, "AddressClass"), "address.street": (0, False, "STRING"),
        "address.geo": (1, False, "AddressClass;GeoClass"), "address.geo.lat": (0, False, "REAL"),
    }
    assert {p: (r.value_count, r.null_count) for p, r in found.items()} == {
        "id": (3, 0), "address": (2, 1), "address.street": (1, 1), "address.geo": (1, 1), "address.geo.lat": (1, 0),
    }


def test_arrays_and_arrays_of_arrays(spark):
    df = spark.createDataFrame(
        [(["a", None], [(1,), (None,), None], [[1, 2], [3]]), (None, [], [None, []])],
        "tags array<string>, items array<struct<x:long>>, grid array<array<int>>",
    )
    found = by_path(catalog.crawl({"t": df}, "main"))
    assert found["tags"].defined_by == "Collection(STRING)" and found["tags"].source_type == "REPEATED STRING"
    assert found["items"].defined_by == "Collection(ItemsClass)"
    assert found["grid"].defined_by == "Collection(Collection(INTEGER))" and found["grid"].array_depth == 2
    assert (found["tags"].value_count, found["tags"].null_count, found["tags"].item_count, found["tags"].max_items) == (1, 1, 2, 2)
    assert (found["items"].value_count, found["items"].item_count) == (2, 3)
    assert (found["items.x"].value_count, found["items.x"].null_count) == (1, 1)
    assert (found["grid"].item_count, found["grid"].max_items) == (3, 2)


def test_wide_patent_like_schema(spark):
    schema = (
        "kind string, grant_date long, inventor array<string>, assignee_h array<struct<country:string,name:string>>, "
        "cpc array<struct<code:string,tree:array<string>,first:boolean>>"
    )
    df = spark.createDataFrame([("A", 1, ["x"], [("US", "n")], [("c", ["t1", "t2"], True), ("d", None, False)])], schema)
    found = by_path(catalog.crawl({"p": df}, "main"))
    assert found["cpc.tree"].item_count == 2 and found["cpc.tree"].null_count == 1
    assert found["cpc.tree"].defined_by == "Collection(STRING)" and found["cpc.first"].defined_by == "BOOLEAN"
    assert found["grant_date"].sql_code == -5 and found["cpc"].sql_code == 12


def test_empty_table(spark):
    found = by_path(catalog.crawl({"t": spark.createDataFrame([], "a int, b array<struct<c:int>>")}, "main"))
    assert all((r.value_count, r.null_count, r.item_count) == (0, 0, 0) for r in found.values())
    assert {p: r.row_count for p, r in found.items()} == {"a": 0, "b": 0, "b.c": None}


def test_counts_come_from_footers(spark, data):
    from tablewright.sources.tables import load, load_counted

    setting = spark.conf.get("spark.sql.sources.useV1SourceList")
    for name in ("orders", "embeddings"):
        usual, counted = load(spark, data, name), load_counted(spark, data, name)
        assert counted.schema == usual.schema
        assert by_path(catalog.crawl_table(counted, "s", name)) == by_path(catalog.crawl_table(usual, "s", name))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == setting
    plan = catalog.crawl_table(load_counted(spark, data, "orders"), "s", "orders")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan


def test_views_are_left_out(spark):
    frames = {"t": spark.range(3)}
    fields = catalog.crawl(frames, "main", views={"v": spark.range(2)})
    assert [r.table_name for r in catalog.tables_of(fields).collect()] == ["t"]


def test_scope(spark):
    tables = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "schema_name string, table_name string")
    frame = lambda *v: spark.createDataFrame([(i,) for i in v], "p string")
    kept = lambda **k: {tuple(r) for r in catalog.in_scope(tables, **k).collect()}
    assert kept(include=frame("a")) == {("a", "x"), ("a", "y")}
    assert kept(include=frame("*.x")) == {("a", "x"), ("b", "x")}
    assert kept(include=frame("a"), exclude=frame("a.y")) == {("a", "x")}
    assert kept(include=frame(), exclude=frame("b", "*.y")) == {("a", "x")}


def test_rule_tables():
    assert len(DATA_PATTERNS) == 14 and len(NAME_PATTERNS) == 89 and len(PERSONAL_CLASSES) == 77
    assert "AUTHENTICATION_CREDENTIALS" in PERSONAL_CLASSES


@pytest.mark.parametrize("column, wanted", [
    ("ssn", "SOCIAL_SECURITY_NUMBER"), ("FirstName", "FIRST_NAME"), ("last_name", "LAST_NAME"), ("e_mail", "EMAIL"),
    ("ip_addr", "ADDRESS"), ("ship_addr", "ADDRESS"), ("note", "NOTES"), ("my_notes", "NOTES"), ("note_id", None),
    ("note_text", "NOTES"), ("account", "ACCOUNT_NUMBER"), ("customer_id", None), ("zip", "POSTAL_CODE"), ("lang", "LANGUAGE"),
])
def test_names(spark, column, wanted):
    fields = spark.createDataFrame([("t", column)], "table_name string, column_name string")
    found = [r.class_name for r in profiling.classify_by_name(fields).collect()]
    assert found == ([wanted] if wanted else [])


def test_look_behind_rule(spark):
    fields = spark.createDataFrame([("t", "IP_addr1"), ("t", "ship_addr")], "table_name string, column_name string")
    hits = {(r.column_name, r.class_name) for r in profiling.name_matches(fields).collect()}
    assert ("IP_addr1", "IP_ADDRESS") in hits and ("ship_addr", "IP_ADDRESS") not in hits


def test_values(spark):
    df = spark.createDataFrame(
        [("a@b.com", "123-45-6789", "10.0.0.1", "000-12-3456"), ("c.d@e.org", "666-45-6789", "10.0.0.300", "nothing")],
        "mail string, ssn string, ip string, other string",
    )
    scores = {(r.column_name, r.class_name): r.score for r in profiling.pattern_matches(df, "t").collect()}
    assert scores["mail", "EMAIL"] == 1.0
    assert scores["ssn", "SOCIAL_SECURITY_NUMBER"] == 0.4
    assert scores["ip", "IP_ADDRESS"] == 0.5
    best = {r.column_name: r.class_name for r in profiling.classify_by_data({"t": df}).collect()}
    assert best["mail"] == "EMAIL"


def test_cheap_tests_never_change_a_match(spark):
    texts = [
        "Jehovah's Witness", "JEWISH", "Korean ASIAN", "fEmAlE", "x@y.com", "x@y.com\n", "1.2.3.4\n", "1.2.3.4\r\n",
        "1.2.3.4 x", "AA:BB:CC:DD:EE:FF", "AA:BB:CC:DD:EE:FF\n", "AA-BB-CC-DD-EE-FF\r\n", "", None, "Straße white", "İ hindu",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    fast = {r.class_name: r.match_count for r in profiling.pattern_matches(df, "t").collect()}
    plain = {name: df.where(F.col("t").rlike(p)).count() for name, p, _ in DATA_PATTERNS}
    assert fast == plain


def test_best_class_tie_goes_to_the_earlier_rule(spark):
    scored = spark.createDataFrame([("t", "c", 5, "B", 0.8), ("t", "c", 2, "A", 0.8), ("t", "c", 1, "Z", 0.5)],
                                   "table_name string, column_name string, rule_no int, class_name string, score double")
    assert profiling.best_class(scored).first().class_name == "A"


def test_null_shares_and_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (3, None)], "a int, b string")
    assert {r.column_name: r.null_share for r in profiling.null_percentages(df, "t").collect()} == {"a": 0.25, "b": 0.75}
    exact = {r.column_name: (r.null_count, r.distinct_count, r.min_value, r.max_value) for r in profiling.profile(df, "t", True).collect()}
    assert exact == {"a": (1, 2, "1", "3"), "b": (3, 1, "x", "x")}
    assert {r.column_name: r.distinct_count for r in profiling.profile(df, "t").collect()} == {"a": 2, "b": 1}


def test_text_types(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "1e400", "true", "2020-01-02", "2020-01-02 03:04:05", "x", None), ("-7", "2", "0.5", "FALSE", "1999-12-31", "2020-01-02T03:04:05.5", "1", None)],
        "i string, n string, f string, b string, d string, t string, s string, z string",
    )
    found = {r.column_name: r.inferred_type for r in profiling.infer_text_types(df).collect()}
    assert found == {"i": "INT64", "n": "NUMERIC", "f": "FLOAT64", "b": "BOOL", "d": "DATE", "t": "DATETIME", "s": "STRING", "z": "STRING"}


def test_json_columns_become_records(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": 2}'), (3, None)], "id int, j string")
    parsed = catalog.parse_complex(df, "j")
    found = by_path(catalog.crawl_table(parsed, "main", "t"))
    assert found["j.b.c"].value_count == 1 and found["j.a"].value_count == 2 and found["j"].null_count == 1


def test_relations(spark):
    fields = spark.createDataFrame(
        [("customer", "id", "INT64", True), ("customer", "name", "STRING", False), ("orders", "customer_id", "INT64", False),
         ("orders", "o_key", "INT64", True), ("items", "i_key", "INT64", True), ("items", "line", "INT64", True),
         ("notes", "line", "FLOAT64", False), ("a", "shared", "INT64", False), ("b", "shared", "INT64", False)],
        "table_name string, field_name string, source_type string, is_pk boolean",
    )
    found = {(r.from_table, r.to_table): (r.rule, r.score) for r in joins.relation_candidates(fields).collect()}
    assert found == {("customer", "orders"): ("field_name_is_id_and_pk", 0.8), ("orders", "items"): ("common_fields_in_both_pk", 0.8)}
    low = {(r.from_table, r.to_table) for r in joins.relation_candidates(fields, threshold=0.2).collect()}
    assert ("a", "b") in low


def test_json_paths_without_a_schema(spark):
    texts = ['{"a": 1, "b": {"c": [1, "x", {"d": true}]}}', '{"a": "s", "b": null}', "[1.5]", "not json", None]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    found = {(r.field_path, r.kind): r.value_count for r in catalog.json_fields(df, "j").collect()}
    assert found == {
        ("j", "OBJECT"): 2, ("j", "ARRAY"): 1, ("j[]", "DECIMAL"): 1, ("j.a", "BIGINT"): 1, ("j.a", "STRING"): 1, ("j.b", "OBJECT"): 1,
        ("j.b.c", "ARRAY"): 1, ("j.b.c[]", "BIGINT"): 1, ("j.b.c[]", "STRING"): 1, ("j.b.c[]", "OBJECT"): 1, ("j.b.c[].d", "BOOLEAN"): 1,
    }


def test_json_columns_are_found(spark):
    df = spark.createDataFrame([("{}", "[1]", "5", None, "{"), (None, '{"a":1}', "{}", None, "{}")], "a string, b string, c string, d string, e string")
    assert catalog.json_columns(df) == ["a", "b"]


def test_discovery_run(spark):
    from tablewright.operators.discovery import discover

    frames = {
        "people": spark.createDataFrame([(i, f"u{i}@example.com", None if i % 2 else "x", '{"zip": "1"}') for i in range(300)],
                                        "id int, contact string, remark string, more string"),
        "hidden": spark.range(5),
    }
    texts = spark.createDataFrame([("people", "more.zip", "postal", 0)], "table_name string, field_path string, description string, position int")
    out = spark.createDataFrame([("*.hidden",)], "p string")
    found = {r.field_path: r for r in discover(frames, "main", exclude=out, descriptions=texts).collect()}
    assert set(found) == {"id", "contact", "remark", "more", "more.zip"}
    assert (found["contact"].class_name, found["contact"].pii, found["contact"].row_count) == ("EMAIL", True, 300)
    assert found["more"].defined_by == "MoreClass" and found["more.zip"].description == "postal"
    assert found["id"].null_share == 0.0 and found["remark"].value_count == 150


def test_json_beyond_the_sample_is_kept(spark):
    """Late keys, mixed kinds, key names like type names and text that is no JSON all survive opening."""
    rows = [(i, '{"k": 1}') for i in range(400)] + [(400, '{"z": 2}'), (401, "not json"), (402, '{"k": "t"}'), (403, '{"OBJECT<x": {"a`b": 7}}'), (404, None)]
    df = spark.createDataFrame(rows, "id int, j string")
    parsed = catalog.parse_complex(df, "j", "j_text")
    assert [(r.id, r.j_text) for r in parsed.where("j_text IS NOT NULL").collect()] == [(401, "not json")]
    got = {r.id: r for r in parsed.selectExpr("id", "j IS NULL AS gone", "CAST(j.k AS string) AS k", "j.z", "j.`OBJECT<x`.`a``b` AS deep").where("id >= 399").collect()}
    assert [(got[i].gone, got[i].k, got[i].z, got[i].deep) for i in range(399, 405)] == [
        (False, "1", None, None), (False, None, 2, None), (True, None, None, None), (False, "t", None, None), (False, None, None, 7), (True, None, None, None)]
    wide = catalog.open_json(df, "j", catalog.json_schema(df, "j", longest=10))
    assert dict(wide.dtypes)["j"] == "variant" and wide.where("j IS NOT NULL").count() == 403


def test_discovery_counts_json_of_the_whole_table(spark):
    """A sample that sees one kind of record does not decide what the table holds."""
    from tablewright.operators.discovery import discover
    from tablewright.operators import discovery

    df = spark.createDataFrame([(i, '{"k": 1}' if i < 200 else '{"z": 2}' if i < 400 else "no json") for i in range(500)], "id int, j string")
    before, discovery.sample = discovery.sample, lambda d: d.where("id < 20")
    try:
        found = {r.field_path: r.value_count for r in discover({"t": df}, "main").collect()}
    finally:
        discovery.sample = before
    assert found == {"id": 500, "j": 400, "j.k": 200, "j.z": 200, "j_text": 100}


def test_data_classes_are_looked_for_in_every_table_with_text(spark, data, tmp_path):
    from pyspark.sql import functions as F

    from tablewright.plans.discovery import WITH_TEXT, classify_by_data
    from tablewright.plans.tables import TABLES

    column = {"orders": "o_orderpriority", "lineitem": "l_returnflag", "events": "event_type", "benchmark": "text"}
    assert set(column) <= set(WITH_TEXT)
    for name in TABLES:
        if name in column:
            rows = spark.read.parquet(f"{data}/{name}.parquet").limit(20).withColumn(column[name], F.lit("jane.doe@example.com"))
            rows.write.parquet(f"{tmp_path}/{name}.parquet")
        else:
            (tmp_path / f"{name}.parquet").symlink_to(f"{data}/{name}.parquet")
    found = {(r["table_name"], r["column_name"]) for r in classify_by_data(spark, str(tmp_path)).collect()}
    assert set(column.items()) <= found


@pytest.mark.parametrize("name", ["lineitem", "events"])
def test_profile_of_a_whole_table(spark, data, name):
    df = spark.read.parquet(f"{data}/{name}.parquet")
    found = {r["column_name"]: r for r in profiling.profile(df, name, exact_distinct=True).collect()}
    assert set(found) == set(df.columns)
    wanted = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(df.columns) for k, f in (("n", F.count), ("d", F.count_distinct))]).first()
    for i, c in enumerate(df.columns):
        assert (found[c]["row_count"] - found[c]["null_count"], found[c]["distinct_count"]) == (wanted[f"n{i}"], wanted[f"d{i}"])


def test_exact_distinct_values_are_counted_by_type(spark):
    rows = [(1, 0.0, "a", True, None), (1, -0.0, "", True, None), (2, float("nan"), None, False, None), (None, None, "a", None, None)]
    df = spark.createDataFrame(rows, "i int, d double, s string, b boolean, n date").withColumn("dotted.name", F.col("i").cast("decimal(5,1)"))
    counted = profiling.profile(df, "t", exact_distinct=True)
    assert {r["column_name"]: r["distinct_count"] for r in counted.collect()} == {"i": 2, "d": 3, "s": 2, "b": 2, "n": 0, "dotted.name": 2}
    plan = counted._jdf.queryExecution().analyzed().toString()
    assert re.search(r"v, cast\(i#\d+ as bigint\)", plan)
