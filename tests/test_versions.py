"""Changes by file: what is not hit keeps its name, whatever the change."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import changes, versions
from tablewright.sources import files


def named(spark, path):
    """Published files and the keys they hold."""
    rows = changes.open_table(spark, path).select("k", versions.file_name().alias("file")).collect()
    out = {}
    for r in rows:
        out.setdefault(r["file"], set()).add(r["k"])
    return out


def sorted_table(spark, path, n=400, pieces=8):
    df = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartitionByRange(pieces, "k")
    changes.publish(df, path)
    return named(spark, path)


def content(spark, path):
    return {(r["k"], r["v"]) for r in changes.open_table(spark, path).collect()}


@pytest.mark.parametrize("change", ["delete_keys", "delete_entity", "upsert"])
def test_untouched_files_keep_their_names(spark, path, change):
    before = sorted_table(spark, path)
    assert len(before) == 8
    hit = {f for f, keys in before.items() if keys & {3, 390}}
    want = {(k, f"v{k}") for k in range(400)}
    if change == "delete_keys":
        gone = spark.createDataFrame([(3,), (390,), (3,), (9999,), (None,)], "k long")
        assert changes.delete_by_keys(spark, path, gone, ["k"]) == 2
        want -= {(3, "v3"), (390, "v390")}
    elif change == "delete_entity":
        assert changes.delete_by_entity(spark, path, "k", 3) == 1
        hit = {f for f, keys in before.items() if 3 in keys}
        want -= {(3, "v3")}
    else:
        source = spark.createDataFrame([(3, "new"), (390, "new"), (5000, "more")], "k long, v string")
        assert changes.upsert(spark, path, source, ["k"]) == {"matched": 2, "inserted": 1}
        want = want - {(3, "v3"), (390, "v390")} | {(3, "new"), (390, "new"), (5000, "more")}
    after = named(spark, path)
    assert content(spark, path) == want
    assert set(before) - set(after) == hit and all(after[f] == before[f] for f in set(before) - hit)


def test_nothing_hit_writes_nothing(spark, path):
    sorted_table(spark, path, 50, 2)
    version = changes.current_version(spark, path)
    for keys in ([(77,)], [], [(None,)]):
        assert changes.delete_by_keys(spark, path, spark.createDataFrame(keys, "k long"), ["k"]) == 0
    assert changes.delete_by_entity(spark, path, "k", 77) == 0
    assert changes.upsert(spark, path, spark.createDataFrame([], "k long, v string"), ["k"]) == {"matched": 0, "inserted": 0}
    assert changes.current_version(spark, path) == version
    assert changes.upsert(spark, path, spark.createDataFrame([(60, "x")], "k long, v string"), ["k"]) == {"matched": 0, "inserted": 1}
    assert version in changes.current_version(spark, path)


def test_files_outside_the_bounds_are_not_read(spark, path):
    sorted_table(spark, path)
    keys = spark.createDataFrame([(3,), (8,)], "k long")
    near = versions.within(changes.open_table(spark, path), keys.agg(*versions.bounds_of(keys.schema, ["k"])).first(), ["k"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,3)" in plan and "LessThanOrEqual(k,8)" in plan
    assert {r["k"] for r in near.collect()} == set(range(3, 9))


def test_several_kinds_of_keys_and_nulls(spark, path):
    schema = "k string, d date, n decimal(20,2), f double, v int"
    day = datetime.date(2024, 2, 29)
    one, two = decimal.Decimal(1), decimal.Decimal(2)
    rows = [("a", day, one, 0.5, 1), ("a", None, one, 0.5, 2), (None, day, None, None, 3), ("b", day, two, float("nan"), 4), ("é", day, two, 1.0, 5)]
    changes.publish(spark.createDataFrame(rows, schema), path)
    keys = ["k", "d", "n", "f"]
    source = spark.createDataFrame([("a", day, one, 0.5, 10), (None, day, None, None, 30), ("b", day, two, float("nan"), 40), ("z", None, None, None, 50)], schema)
    assert changes.upsert(spark, path, source, keys) == {"matched": 3, "inserted": 1}
    assert sorted(r["v"] for r in changes.open_table(spark, path).collect()) == [2, 5, 10, 30, 40, 50]
    assert changes.delete_by_keys(spark, path, source, keys) == 2  # nulls match nothing
    assert sorted(r["v"] for r in changes.open_table(spark, path).collect()) == [2, 5, 30, 50]
    assert changes.delete_by_keys(spark, path, spark.createDataFrame([("2", "x")], "v string, more string"), ["v"]) == 1


def test_repeated_target_keys_count_once_as_matched(spark, path):
    changes.publish(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"), path)
    assert changes.upsert(spark, path, spark.createDataFrame([(1, "z")], "k int, v string"), ["k"]) == {"matched": 1, "inserted": 0}
    assert content(spark, path) == {(1, "z"), (2, "c")}


def test_a_change_gives_way_to_another_writer(spark, path):
    sorted_table(spark, path, 20, 2)
    version = changes.current_version(spark, path)
    rows = changes.open_table(spark, path)
    changes.publish_more(spark.createDataFrame([(99, "x")], "k long, v string"), path)
    with pytest.raises(changes.PublishError):
        versions.replace_files(spark, path, version, [], rows)
    assert len(content(spark, path)) == 21


def test_small_files_are_joined_and_large_ones_stay(spark, path):
    sorted_table(spark, path, 2000, 1)
    large = set(named(spark, path))
    for n in range(6):
        changes.publish_more(spark.createDataFrame([(10_000 + n, "x")], "k long, v string").coalesce(1), path)
    changes.delete_by_entity(spark, path, "k", 10_003)
    want = content(spark, path)
    limit = 4000
    assert all(size > limit for name in large for _, size in files.below(spark, f"{path}/{name}"))
    assert versions.compact(spark, path, small_bytes=limit) == 5
    after = named(spark, path)
    assert content(spark, path) == want and large < set(after) and len(after) == len(large) + 1
    assert versions.compact(spark, path, small_bytes=limit) == 0
    versions.drop_old_versions(spark, path)
    assert content(spark, path) == want
    kept = {f"{n}/{x}" for n in files.child_names(spark, path) if n.startswith("v-") for x, _ in files.below(spark, f"{path}/{n}")}
    assert kept == set(after)


def test_many_changes_in_a_row(spark, path):
    """Deletes and upserts against a dictionary."""
    held = {k: f"v{k}" for k in range(200)}
    sorted_table(spark, path, 200, 4)
    for step in range(4):
        keys = [k for k in sorted(held) if k % 7 == step]
        changes.delete_by_keys(spark, path, spark.createDataFrame([(k,) for k in keys], "k long"), ["k"])
        held = {k: v for k, v in held.items() if k not in keys}
        new = {k: f"s{step}" for k in range(step * 50, step * 50 + 60, 11)}
        counts = changes.upsert(spark, path, spark.createDataFrame(list(new.items()), "k long, v string"), ["k"])
        assert counts == {"matched": len(set(new) & set(held)), "inserted": len(set(new) - set(held))}
        held |= new
        assert content(spark, path) == set(held.items())


def test_counts_say_what_the_changes_do(spark, path):
    target = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (2, "d")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (None, "y"), (9, "z")], "k int, v string")
    found = {r.statement: r.rows_affected for r in changes.change_counts(target, source, ["k"]).collect()}
    assert found == {"update": 2, "insert": 1, "delete": 1, "query": -1}
    changes.publish(target, path)
    assert changes.delete_by_keys(spark, path, source, ["k"]) == found["delete"]
    changes.publish(target, path)
    assert changes.upsert(spark, path, source, ["k"]) == {"matched": found["update"], "inserted": found["insert"]}


def test_map_values_that_do_not_fit_are_errors(spark, path):
    target = T.StructType.fromDDL("id int, m map<string,int>, deep array<struct<m: map<string,map<int,date>>>>")
    df = spark.sql("""
        SELECT 1 id, map('a', '1', 'b', CAST(NULL AS string)) m, array(named_struct('m', map('x', map('1', '2024-01-01')))) deep
        UNION ALL SELECT 2, map('a', 'x'), NULL
        UNION ALL SELECT 3, NULL, array(named_struct('m', map('x', map('1', 'no day'))))
        UNION ALL SELECT 4, map(), array(named_struct('m', map('x', map('no key', '2024-01-01'))))
        UNION ALL SELECT 5, map('a', '7'), array(NULL, named_struct('m', NULL))
    """)
    good, bad = changes.split_errors(df, target)
    assert sorted((r["id"], r["m"]) for r in good.collect()) == [(1, {"a": 1, "b": None}), (5, {"a": 7})]
    assert sorted((r["column_name"], r["row_json"][:7]) for r in bad.collect()) == [("deep", '{"id":3'), ("deep", '{"id":4'), ("m", '{"id":2')]
    assert changes.load_with_errors(df, target, f"{path}/good", f"{path}/bad") == (2, 3)
    strict = changes.write_enforced(df.where("id IN (1, 5)"), target, f"{path}/strict")
    assert strict == 2 and dict(changes.open_table(spark, f"{path}/strict").where("id = 1").first()["deep"][0]["m"]["x"]) == {1: datetime.date(2024, 1, 1)}


def test_a_lost_or_old_pointer_does_no_harm(spark, path):
    for n in range(3):
        changes.publish_more(spark.createDataFrame([(n, "x")], "k int, v string"), path)
        if n == 0:
            old = files.read_text(spark, f"{path}/{versions.POINTER}")
    now = changes.current_version(spark, path)
    files.replace_text(spark, f"{path}/{versions.POINTER}", old)
    assert changes.current_version(spark, path) == now
    files.delete_tree(spark, f"{path}/{versions.POINTER}")
    assert changes.current_version(spark, path) == now and len(content(spark, path)) == 3
    assert files.try_read_text(spark, f"{path}/{versions.POINTER}") is None


def test_a_table_that_is_what_it_was_before_has_a_version_of_its_own(spark, path):
    one, two = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(2, "b")], "k int, v string")
    changes.publish(one.coalesce(1), path)
    for _ in range(3):
        changes.publish_more(two.coalesce(1), path)
        assert content(spark, path) == {(1, "a"), (2, "b")}
        assert changes.delete_by_entity(spark, path, "k", 2) == 1
        assert content(spark, path) == {(1, "a")}
    version = changes.current_version(spark, path)
    versions.show(spark, path, versions.entries(version), version)
    assert changes.current_version(spark, path) != version and content(spark, path) == {(1, "a")}
    assert changes.delete_by_entity(spark, path, "k", 1) == 1 and content(spark, path) == set()
    versions.drop_old_versions(spark, path)
    assert changes.open_table(spark, path).columns == ["k", "v"]


def test_a_search_carries_no_paths(spark, path, monkeypatch):
    sorted_table(spark, path)
    seen = []
    monkeypatch.setattr(changes, "hits", lambda df, file, *more: seen.append(df.schema[file].dataType) or versions.hits(df, file, *more))
    assert changes.delete_by_keys(spark, path, spark.createDataFrame([(3,)], "k long"), ["k"]) == 1
    assert changes.delete_by_entity(spark, path, "k", 4) == 1
    assert changes.upsert(spark, path, spark.createDataFrame([(5, "new")], "k long, v string"), ["k"]) == {"matched": 1, "inserted": 0}
    assert seen == [T.LongType()] * 3


def test_files_of_one_name_are_told_apart(spark, path):
    import os

    for low in (0, 10):
        changes.publish_more(spark.range(low, low + 10).coalesce(1).select(F.col("id").alias("k"), F.lit("v").alias("v")), path)
    place = files.inner_path(spark, path)
    first, second = [f"{place}/{e}" for e in versions.entries(changes.current_version(spark, path))]
    name, other = [next(f for f in os.listdir(p) if f.endswith(".parquet")) for p in (first, second)]
    os.rename(f"{second}/{other}", f"{second}/{name}")
    os.rename(f"{second}/.{other}.crc", f"{second}/.{name}.crc")
    assert changes.delete_by_keys(spark, path, spark.createDataFrame([(13,)], "k long"), ["k"]) == 1
    assert {k for k, _ in content(spark, path)} == set(range(20)) - {13}
    assert versions.entries(changes.current_version(spark, path))[0] == os.path.basename(first)
