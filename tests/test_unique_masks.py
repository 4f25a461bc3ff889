"""Masks that are both consistent and unique, across tables, runs and places inside records."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tablewright.operators import masking, versions
from tablewright.rules.generators import BY_CLASS, GENERATORS


def masks(df, key, column):
    return {r[key]: r[column] for r in df.collect()}


@pytest.mark.parametrize("name", [c for c, _, _, _, once in GENERATORS if once])
def test_tables_share_masks_and_no_two_values_do(spark, path, name):
    a = spark.createDataFrame([(1, "a@x"), (2, "b@x"), (3, None), (4, "a@x")], "id int, v string")
    b = spark.createDataFrame([(1, "c@x"), (2, "a@x"), (3, "d@x")], "id int, v string")
    first = masks(masking.mask_by_class(a, {"v": name}, "id", path), "id", "v")
    second = masks(masking.mask_by_class(b, {"v": name}, "id", path), "id", "v")
    again = masks(masking.mask_by_class(a, {"v": name}, "id", path), "id", "v")
    assert first == again and first[3] is None and first[1] == first[4] == second[2]
    assert len({first[1], first[2], second[1], second[3]}) == 4
    if BY_CLASS[name][0] == "pattern":
        assert all(re.fullmatch(BY_CLASS[name][1]["pattern"], v) for v in second.values())


def test_known_values_cost_no_write_and_masks_do_not_rank(spark, path):
    values = spark.range(300).select(F.concat(F.lit("u"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("v"))
    found = masks(masking.learn_masks(values, "v", path, "ACCOUNT_NUMBER"), "source_value", "target_value")
    version = versions.current_version(spark, f"{path}/ACCOUNT_NUMBER")
    masking.learn_masks(values.limit(5), "v", path, "ACCOUNT_NUMBER")
    assert versions.current_version(spark, f"{path}/ACCOUNT_NUMBER") == version
    numbers = [int(found[k]) for k in sorted(found)]
    assert len(set(numbers)) == 300 and all(1000 <= n <= 1000000 for n in numbers)
    assert 100 < sum(x < y for x, y in zip(numbers, numbers[1:])) < 200
    rows = masking.known_masks(spark, path, "ACCOUNT_NUMBER").orderBy("number").collect()
    taken = [int(r["target_value"]) for r in rows]
    assert 100 < sum(x < y for x, y in zip(taken, taken[1:])) < 200
    other = masking.learn_masks(values, "v", f"{path}/other", "ACCOUNT_NUMBER", seed="secret")
    assert sum(found[k] == v for k, v in masks(other, "source_value", "target_value").items()) < 5


def test_numbers_and_texts_of_one_value_are_one(spark, path):
    a = spark.createDataFrame([(7,), (8,)], "k long").withColumn("id", F.col("k"))
    b = spark.createDataFrame([("8",), ("x",)], "k string").withColumn("id", F.col("k"))
    left = masks(masking.mask_by_class(a, {"k": "BANK_ACCOUNT"}, "id", path), "id", "k")
    right = masks(masking.mask_by_class(b, {"k": "BANK_ACCOUNT"}, "id", path), "id", "k")
    assert str(left[8]) == right["8"] and len({str(left[7]), right["8"], right["x"]}) == 3


def test_two_runs_at_once_agree(spark, path):
    def learn(n):
        values = spark.range(n * 20, n * 20 + 60).select(F.concat(F.lit("v"), "id").alias("v"))
        return masks(masking.learn_masks(values, "v", path, "AFFILIATE_NAME"), "source_value", "target_value")

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(learn, range(3)))
    rows = masking.known_masks(spark, path, "AFFILIATE_NAME").collect()
    assert len(rows) == len({r["source_value"] for r in rows}) == len({r["target_value"] for r in rows}) == 100
    assert sorted(r["number"] for r in rows) == list(range(1, 101))


def test_room_is_kept_over_all_tables(spark, path, monkeypatch):
    monkeypatch.setitem(BY_CLASS, "ACCOUNT_NUMBER", ("number", {"low": 1, "high": 5}, True, True))
    for low, high in ((0, 3), (1, 5)):
        out = masking.learn_masks(spark.range(low, high), "id", path, "ACCOUNT_NUMBER")
    assert sorted(int(r["target_value"]) for r in out.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(masking.DomainTooSmall):
        masking.learn_masks(spark.range(9), "id", path, "ACCOUNT_NUMBER")


@pytest.mark.parametrize("stored", [True, False])
def test_unique_values_inside_records_and_arrays(spark, path, stored):
    df = spark.createDataFrame(
        [(1, "a@x", ("a@x", "keep"), [("b@x", 1), (None, 2), ("a@x", 3)], ["c@x", "a@x"]), (2, "b@x", None, None, []),
         (3, None, (None, "k"), [None, ("d@x", 4)], [None])],
        "id int, email string, who struct<email:string,other:string>, kin array<struct<email:string,n:int>>, list array<string>",
    )
    classes = {"email": "EMAIL", "who.email": "EMAIL", "kin.email": "EMAIL", "list": "EMAIL", "id": "NAME_WITHOUT_RULE"}
    out = {r["id"]: r for r in masking.mask_by_class(df, classes, "id", path if stored else None).collect()}
    one, two, three = out[1], out[2], out[3]
    pattern = BY_CLASS["EMAIL"][1]["pattern"]
    if stored:
        assert one.email == one.who.email == one.kin[2].email == one.list[1]
        assert two.email == one.kin[0].email
        assert len({one.email, two.email, one.list[0], three.kin[1].email}) == 4
    assert re.fullmatch(pattern, one.who.email) and re.fullmatch(pattern, one.list[0])
    assert one.who.other == "keep" and [k.n for k in one.kin] == [1, 2, 3] and one.kin[1].email is None
    assert two.who is None and two.kin is None and two.list == []
    assert three.email is None and three.who.email is None and three.kin[0] is None and three.list == [None]


def test_a_masked_row_id_still_draws_for_other_columns(spark, path):
    df = spark.createDataFrame([(1, "Ann"), (2, "Ann")], "id int, name string")
    out = masking.mask_by_class(df, {"id": "BANK_ACCOUNT", "name": "NAME"}, "id", path).collect()
    plain = masks(masking.mask_by_class(df, {"name": "NAME"}, "id"), "id", "name")
    assert {r["name"] for r in out} == set(plain.values()) and len({r["id"] for r in out} | {1, 2}) == 4
