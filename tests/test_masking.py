import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import entities, generating, joins, masking
from tablewright.operators.changes import open_table, publish
from tablewright.rules.generators import BY_CLASS, GENERATORS

SHAPES = {
    "credit_card": r"\d{16}", "driver_license": r"[A-Z]{1,2}\d{1,6}[A-Z]?", "email": r"[a-z0-9.]{6,20}@[a-z.]{4,10}\.(com|net|org)",
    "telephone": r"\+1 \([2-9][0-9]{2}\)-[2-9][0-9]{2}-[0-9]{4}", "ssn": r"\d{3}-\d{2}-\d{4}", "postal_code": r"\d{5}(-\d{4})?",
    "mac_address": r"([0-9A-F]{2}[:-]){5}([0-9A-F]{2})", "ip_address": r"(\d{1,3}\.){3}\d{1,3}", "two_letters": r"[A-Z]{2}",
}


def luhn(number):
    digits = [int(d) for d in reversed(number)]
    return sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(digits)) % 10 == 0


def test_generated_shapes(spark):
    rows = spark.range(300).select(*[generating.generate_class(c, c, F.col("id")).alias(c) for c, *_ in GENERATORS]).collect()
    for name, (generator, settings, _, _) in BY_CLASS.items():
        values = [r[name] for r in rows]
        if generator in SHAPES:
            assert all(re.fullmatch(SHAPES[generator], v) for v in values), name
        if generator == "credit_card":
            assert all(luhn(v) for v in values)
        if generator == "number":
            assert all(settings["low"] <= v <= settings["high"] for v in values)
        if generator == "string":
            assert all(settings["low"] <= len(v) <= settings["high"] for v in values)
        if generator == "choice":
            assert set(values) <= set(settings["items"])


def test_card_prefix_is_kept(spark):
    out = spark.createDataFrame([("4111222233334444",)], "c string").select(generating.generate_class("DEBIT_CARD", "x", F.col("c")).alias("c")).first().c
    assert out.startswith("4111") and luhn(out)


def test_no_generator_gives_null(spark):
    assert spark.range(1).select(generating.generate_class("CITY", "c", F.col("id")).alias("v")).first().v is None


def test_same_value_same_mask_in_two_tables(spark):
    a = spark.createDataFrame([(1, "Ann"), (2, "Bob"), (3, None)], "id int, full_name string")
    b = spark.createDataFrame([(9, "Bob"), (8, "Ann")], "key int, who string")
    left = {r.id: r.full_name for r in masking.mask_by_class(a, {"full_name": "FULL_NAME"}, "id").collect()}
    right = {r.key: r.who for r in masking.mask_by_class(b, {"who": "FULL_NAME"}, "key").collect()}
    assert left[1] == right[8] and left[2] == right[9] and left[1] != left[2] and left[3] is None


@pytest.mark.parametrize("name", [c for c, _, _, _, once in GENERATORS if once])
def test_unique_masks_differ(spark, name):
    values = spark.range(500).select("id", F.concat(F.lit("v"), F.col("id") % 250).alias("v"))
    out = masking.mask_by_class(values.unionByName(spark.createDataFrame([(999, None)], "id long, v string")), {"v": name}, "id")
    masked = {r.id: r.v for r in out.collect()}
    assert len(masked) == 501 and masked[999] is None
    assert len(set(masked.values())) == 251 and masked[0] == masked[250]
    if BY_CLASS[name][0] in SHAPES:
        assert all(re.fullmatch(SHAPES[BY_CLASS[name][0]], v) for v in masked.values() if v)


def test_unique_number_room(spark, monkeypatch):
    monkeypatch.setitem(BY_CLASS, "ACCOUNT_NUMBER", ("number", {"low": 1, "high": 3}, True, True))
    with pytest.raises(masking.DomainTooSmall):
        masking.unique_mapping(spark.range(4).toDF("n"), "n", "ACCOUNT_NUMBER")


def test_nested_values_are_masked_in_place(spark):
    df = spark.createDataFrame(
        [(1, ("Ann", "keep"), [("x", 1), ("y", 2), (None, 3)]), (2, None, None)],
        "id int, who struct<name:string,other:string>, kin array<struct<name:string,n:int>>",
    )
    out = {r.id: r for r in masking.mask_by_class(df, {"who.name": "FULL_NAME", "kin.name": "NAME", "zzz": "CITY"}, "id").collect()}
    assert out[1].who.other == "keep" and out[1].who.name not in ("Ann", None)
    assert [k.n for k in out[1].kin] == [1, 2, 3] and out[1].kin[2].name is None
    assert out[1].kin[0].name != out[1].kin[1].name and 10 <= len(out[1].kin[0].name) <= 20
    assert out[2].who is None and out[2].kin is None


def test_long_lists(spark):
    items = spark.range(50).select(F.col("id").alias("item_no"), F.concat(F.lit("n"), "id").alias("name"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, v string")
    out = {r.id: r.v for r in masking.mask_from_table(df, "v", "first", items).collect()}
    short = {r.id: r.v for r in df.select("id", masking.mask_from(F.col("v"), "first", [f"n{i}" for i in range(50)]).alias("v")).collect()}
    assert out == short and out[4] is None


def test_mapping_grows_and_keeps_its_numbers(spark, path):
    first = masking.extend_mapping(spark, path, spark.createDataFrame([(5,), (3,), (5,), (None,)], "k int"), "k")
    assert {r.source_value: r.target_value for r in first.collect()} == {3: 1, 5: 2}
    second = masking.extend_mapping(spark, path, spark.createDataFrame([(1,), (5,), (9,)], "k int"), "k")
    assert {r.source_value: r.target_value for r in second.collect()} == {3: 1, 5: 2, 1: 3, 9: 4}


def test_subset_and_new_keys_leave_no_orphans(spark, data):
    from tablewright.sources.tables import load

    found = joins.entity_subset(
        load(spark, data, "customer").where("c_mktsegment = 'BUILDING'"), "customer",
        [("orders", load(spark, data, "orders"), "o_custkey", "customer", "c_custkey"),
         ("lineitem", load(spark, data, "lineitem"), "l_orderkey", "orders", "o_orderkey")],
    )
    mapping = masking.key_mapping([(found["orders"], "o_orderkey")])
    parents = joins.replace_keys(found["orders"], mapping, "o_orderkey")
    lines = joins.replace_keys(found["lineitem"], mapping, "l_orderkey")
    assert lines.count() > 0
    assert lines.join(parents, lines.l_orderkey == parents.o_orderkey, "left_anti").count() == 0
    assert parents.agg(F.max("o_orderkey"), F.count("*"), F.countDistinct("o_orderkey")).first()[0:3] == (parents.count(),) * 3


def test_children_of_huge_and_childless_parents(spark):
    parents = spark.createDataFrame([(1, 25), (2, 0), (3, 3), (4, -1), (5, None)], "id int, n int")
    for block in (10_000, 7):
        out = joins.children_of(parents, {"id": "owner"}, F.col("n"), block=block)
        assert out.dtypes == [("owner", "int"), ("child_no", "int")]
        assert sorted(tuple(r) for r in out.collect()) == [(1, i) for i in range(1, 26)] + [(3, i) for i in range(1, 4)]


def test_generated_children_keep_parent_and_sequence(spark):
    schema = T.StructType([T.StructField("owner", T.LongType()), T.StructField("seq", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("amount", T.DoubleType()), T.StructField("day", T.DateType()), T.StructField("ok", T.BooleanType())])
    rows = generating.generate_children(spark.range(1, 4), {"id": "owner"}, 2, schema, "seq", {"lang": "LANGUAGE"}).collect()
    assert [(r.owner, r.seq) for r in sorted(rows, key=lambda r: r.seq)] == [(1, 1), (1, 2), (2, 3), (2, 4), (3, 5), (3, 6)]
    assert all(r.lang in BY_CLASS["LANGUAGE"][1]["items"] and r.day is not None and r.ok is not None for r in rows)
    again = generating.generate_children(spark.range(1, 4), {"id": "owner"}, 2, schema, "seq", {"lang": "LANGUAGE"}).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_sync_outcomes(spark):
    flags = spark.createDataFrame(
        [(1, True, True, False), (2, True, False, False), (3, False, True, False), (4, False, False, True), (5, False, False, False)],
        "entity int, sync boolean, known boolean, delete_only boolean",
    )
    outcomes = entities.sync_outcomes(flags)
    assert {r.entity: r.outcome for r in outcomes.collect()} == {1: "reload", 2: "reload", 3: "keep", 4: "keep", 5: "failed"}
    with pytest.raises(LookupError, match="5"):
        entities.require_synced(outcomes)
    source = spark.createDataFrame([(1, "new"), (2, "new"), (3, "new")], "k int, v string")
    target = spark.createDataFrame([(1, "old"), (1, "older"), (3, "old"), (8, "old")], "k int, v string")
    rows = sorted(tuple(r) for r in entities.sync_rows(outcomes, source, target, "k").collect())
    assert rows == [(1, "new"), (2, "new"), (3, "old"), (8, "old")]


def test_missing_entities(spark):
    wanted, source = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int")
    with pytest.raises(LookupError, match="2"):
        joins.require_keys(wanted, source, "k")
    joins.require_keys(wanted, source, "k", deleting_child=True)
    joins.require_keys(wanted.limit(1), source, "k")


def test_table_task(spark, path):
    df = spark.range(10).toDF("n")
    publish(df, path)
    task = entities.TableTask(where="n >= ?", params=[("n", "6")], delete=True)
    assert entities.run_table_task(spark, df, task, path) == {"counted": 4, "removed": 10, "loaded": 4, "stored": 4}
    with pytest.raises(ValueError):
        entities.run_table_task(spark, df, entities.TableTask(extract="other"), path)
    assert open_table(spark, path).count() == 4
