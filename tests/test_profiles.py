"""Kept profiles, and JSON paths by one parse."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes, profiles, versions
from tablewright.sources import catalog


def rows(spark, low, high):
    return spark.range(low, high).select(
        "id", (F.col("id") % 37).cast("int").alias("m"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), "id")).alias("t"),
        (F.col("id") / 7).alias("f"), F.array("id").alias("a"), F.struct("id").alias("s"), F.create_map(F.lit("k"), "id").alias("mp"),
        F.expr("date_add(date'2024-01-01', cast(id % 400 as int))").alias("d"), F.lit(None).cast("string").alias("z"),
    )


def profile(spark, path, store):
    return sorted((tuple(r) for r in profiles.read_profile(spark, path, store, "t").collect()), key=repr)


def fresh(spark, path, name):
    """The profile of the same rows, published as one and measured from nothing."""
    changes.publish(changes.open_table(spark, path), f"{path}-{name}")
    return profile(spark, f"{path}-{name}", f"{path}-{name}-states")


def test_a_grown_table_has_the_profile_of_a_fresh_one(spark, path):
    table, store = f"{path}/t", f"{path}/states"
    changes.publish(rows(spark, 0, 9000), table)
    assert profiles.update_profile(spark, table, store) == 1
    assert profile(spark, table, store) == fresh(spark, table, "a")
    changes.publish_more(rows(spark, 8000, 12000), table)
    assert profiles.update_profile(spark, table, store) == 1
    assert profiles.update_profile(spark, table, store) == 0
    grown = profile(spark, table, store)
    assert grown == fresh(spark, table, "b")
    found = {r[1]: r for r in grown}
    assert found["id"][2:6] == (13000, 0, "0", "11999") and abs(found["id"][6] - 12000) < 700
    assert found["t"][3] == 2600 and found["z"][2:] == (13000, 13000, None, None, 0)
    assert found["m"][4:7] == ("0", "36", 37) and found["a"][4:6] == (None, None) and abs(found["mp"][6] - 12000) < 700


def test_only_written_entries_are_measured_again(spark, path, monkeypatch):
    table, store = f"{path}/t", f"{path}/states"
    changes.publish(rows(spark, 0, 800).repartitionByRange(8, "id"), table)
    profiles.update_profile(spark, table, store)
    changes.delete_by_entity(spark, table, "id", 3)
    left = profiles.update_profile(spark, table, store)
    assert left == len(versions.entries(changes.current_version(spark, table)))  # the folder is listed by its files now
    changes.delete_by_entity(spark, table, "id", 790)
    assert profiles.update_profile(spark, table, store) == 1
    assert profile(spark, table, store) == fresh(spark, table, "c")


def test_empty_and_changed_tables(spark, path):
    table, store = f"{path}/t", f"{path}/states"
    changes.publish(rows(spark, 0, 0), table)
    assert {r[2:] for r in profile(spark, table, store)} == {(0, 0, None, None, 0)}
    changes.publish(spark.range(4).toDF("other"), table)
    assert profile(spark, table, store) == [("t", "other", 4, 0, "0", "3", 4)]
    with pytest.raises(FileNotFoundError):
        profiles.update_profile(spark, f"{path}/none", store)


def test_json_text_is_parsed_once(spark, path):
    texts = ['{"a": {"b": [{"c": 1}, {"c": "x", "d": null}]}, "e": [[1], []]}', "[1, [2]]", "7", "no json", None, "{}"]
    spark.createDataFrame([(t,) for t in texts], "j string").write.parquet(path)
    found = catalog.json_fields(spark.read.parquet(path), "j")
    assert {(r["field_path"], r["kind"]): r["value_count"] for r in found.collect()} == {
        ("j", "OBJECT"): 2, ("j", "ARRAY"): 1, ("j", "BIGINT"): 1, ("j.a", "OBJECT"): 1, ("j.a.b", "ARRAY"): 1, ("j.a.b[]", "OBJECT"): 2,
        ("j.a.b[].c", "BIGINT"): 1, ("j.a.b[].c", "STRING"): 1, ("j.e", "ARRAY"): 1, ("j.e[]", "ARRAY"): 2, ("j.e[][]", "BIGINT"): 1,
        ("j[]", "BIGINT"): 1, ("j[]", "ARRAY"): 1, ("j[][]", "BIGINT"): 1,
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert path.split("/")[-1] not in plan and "parse_json" not in plan


def test_new_entries_are_read_once(spark, path, monkeypatch):
    table, store = f"{path}/t", f"{path}/states"
    changes.publish(rows(spark, 0, 50), table)
    changes.publish_more(rows(spark, 0, 50).limit(0), table)
    plans, stage = [], profiles.stage
    monkeypatch.setattr(profiles, "stage", lambda df, p: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stage(df, p))
    assert profiles.update_profile(spark, table, store) == 2
    assert plans[0].count("parquet") == 1
    assert {r[2] for r in profile(spark, table, store)} == {50}
