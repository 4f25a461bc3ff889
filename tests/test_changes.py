import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import changes
from tablewright.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs(spark, *items):
    return spark.createDataFrame(list(items), "k int, v string")


def test_a_failing_publish_leaves_the_table_as_it_was(spark, path):
    changes.publish(pairs(spark, (1, "a")), path)
    bad = spark.range(0, 1000, 1, 4).select(F.expr("cast(if(id = 999, 'x', '1') as int)").alias("k"), F.lit("b").alias("v"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        changes.publish(bad, path)
    assert rows(changes.open_table(spark, path)) == [(1, "a")]


def test_first_publish_that_fails_shows_nothing(spark, path):
    with pytest.raises(Exception):
        changes.publish(spark.range(5).select(F.expr("cast('x' as int)").alias("k")), path)
    with pytest.raises(FileNotFoundError):
        changes.open_table(spark, path)


def test_publish_refuses_a_version_it_was_not_made_from(spark, path):
    changes.publish(pairs(spark, (1, "a")), path)
    old = changes.current_version(spark, path)
    changes.publish(pairs(spark, (2, "b")), path)
    with pytest.raises(changes.PublishError):
        changes.publish(pairs(spark, (3, "c")), path, expect=old)
    assert rows(changes.open_table(spark, path)) == [(2, "b")]


def test_tables_grow_together_or_not_at_all(spark, path):
    a, b = f"{path}/a", f"{path}/b"
    changes.publish(pairs(spark, (0, "old")), a)
    bad = spark.range(3).select(F.expr("cast('x' as int)").alias("k"), F.lit("c").alias("v"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        changes.publish_more_together({a: pairs(spark, (1, "a")), b: bad})
    assert rows(changes.open_table(spark, a)) == [(0, "old")]
    assert changes.publish_more_together({a: pairs(spark, (1, "a")), b: pairs(spark, (2, "b"))}) == {a: 1, b: 1}
    assert rows(changes.open_table(spark, a)) == [(0, "old"), (1, "a")] and rows(changes.open_table(spark, b)) == [(2, "b")]
    with pytest.raises(ValueError, match="extra"):
        changes.publish_more(spark.createDataFrame([(1, 2)], "k int, extra int"), a)
    assert changes.delete_by_entity(spark, a, "k", 0) == 1
    assert rows(changes.open_table(spark, a)) == [(1, "a")]
    assert len(changes.drop_old_versions(spark, a)) == 3 and rows(changes.open_table(spark, a)) == [(1, "a")]


def test_append_fits_the_stored_columns(spark, path):
    changes.append(pairs(spark, (1, "a")), path)
    changes.append(spark.createDataFrame([("7",)], "k string"), path)
    with pytest.raises(ValueError, match="extra"):
        changes.append(spark.createDataFrame([(1, 2)], "k int, extra int"), path)
    assert rows(spark.read.parquet(path)) == sorted([(1, "a"), (7, None)], key=repr)


def test_old_versions_can_be_dropped(spark, path):
    for n in range(3):
        changes.publish(pairs(spark, (n, "x")), path)
    assert len(changes.drop_old_versions(spark, path)) == 2
    assert rows(changes.open_table(spark, path)) == [(2, "x")]
    assert len([n for n in files.child_names(spark, path) if n.startswith("v-")]) == 1


def test_appended_rows_stay_when_a_later_batch_fails(spark, path):
    changes.append(pairs(spark, (1, "a"), (2, "b")), path)
    bad = spark.range(3).select(F.expr("cast('x' as int)").alias("k"), F.lit("c").alias("v"))
    with pytest.raises(Exception):
        changes.append(bad, path)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b")]


def test_append_bounds_the_rows_of_a_file(spark, path):
    changes.append(spark.range(0, 2500, 1, 1).toDF("k"), path, 0)
    counts = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in counts) == [500, 1000, 1000]


def test_delete_all_and_truncate_keep_the_columns(spark, path):
    for empty in (changes.delete_all, changes.truncate):
        changes.publish(pairs(spark, (1, "a"), (2, "b")), path)
        assert empty(spark, path) in (2, None)
        left = changes.open_table(spark, path)
        assert left.count() == 0 and left.dtypes == [("k", "int"), ("v", "string")]


def test_delete_by_several_keys(spark, path):
    changes.publish(pairs(spark, (1, "a"), (1, "b"), (2, "a"), (None, "a")), path)
    gone = pairs(spark, (1, "a"), (1, "a"), (2, "z"))
    assert changes.delete_by_keys(spark, path, gone, ["k", "v"]) == 1
    assert rows(changes.open_table(spark, path)) == sorted([(1, "b"), (2, "a"), (None, "a")], key=repr)


def test_delete_by_entity_keeps_null_ids(spark, path):
    changes.publish(pairs(spark, (1, "a"), (None, "b"), (2, "c")), path)
    assert changes.delete_by_entity(spark, path, "k", 1) == 1
    assert rows(changes.open_table(spark, path)) == sorted([(None, "b"), (2, "c")], key=repr)


def test_upsert(spark, path):
    changes.publish(pairs(spark, (1, "a"), (2, "b"), (None, "n")), path)
    counts = changes.upsert(spark, path, pairs(spark, (2, "B"), (3, "C"), (None, "N")), ["k"])
    assert counts == {"matched": 2, "inserted": 1}
    assert rows(changes.open_table(spark, path)) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "N")], key=repr)
    with pytest.raises(ValueError, match="not unique"):
        changes.upsert(spark, path, pairs(spark, (5, "x"), (5, "y")), ["k"])


def test_errors_are_set_aside_whole(spark, path):
    df = spark.createDataFrame([("1", "2.5"), ("x", "y"), (None, "3")], "a string, b string")
    target = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    good, bad = changes.split_errors(df, target)
    assert rows(good) == sorted([(1, 2.5, None), (None, 3.0, None)], key=repr)
    assert rows(bad) == [("a", "x", '{"a":"x","b":"y"}'), ("b", "y", '{"a":"x","b":"y"}')]


def test_load_with_and_without_errors(spark, path):
    target = T.StructType([T.StructField("a", T.IntegerType())])
    for texts, wanted in ((("1", "x", None), (2, 1)), (("1", "2"), (2, 0))):
        df = spark.createDataFrame([(t,) for t in texts], "a string")
        assert changes.load_with_errors(df, target, f"{path}/good", f"{path}/bad") == wanted
        assert changes.open_table(spark, f"{path}/bad").columns == ["column_name", "raw_value", "row_json"]


def test_levels_stop_after_a_failure(spark, path):
    bad = spark.range(3).select(F.expr("cast('x' as int)").alias("k"))
    levels = [{"a": pairs(spark, (1, "a"))}, {"b": bad, "c": pairs(spark, (1, "c"))}, {"d": pairs(spark, (1, "d"))}]
    status = {r.table_name: (r.level, r.status, r.row_count) for r in changes.load_by_level(spark, levels, path).collect()}
    assert status == {"a": (0, "done", 1), "b": (1, "failed", None), "c": (1, "done", 1), "d": (2, "skipped", None)}


def test_change_counts(spark):
    target, source = pairs(spark, (1, "a"), (1, "b"), (2, "c")), pairs(spark, (1, "x"), (9, "y"))
    found = {r.statement: r.rows_affected for r in changes.change_counts(target, source, ["k"]).collect()}
    assert found == {"update": 1, "insert": 1, "delete": 2, "query": -1}


def test_a_bad_value_holds_back_its_whole_entity(spark):
    df = spark.createDataFrame([("1", "2.5"), ("1", "oops"), ("2", "3"), (None, "4"), (None, "bad")], "id string, v string")
    target = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    good, errors, outcomes = changes.split_entities(df, target, "id")
    assert rows(good) == sorted([(2, 3.0), (None, 4.0)], key=repr)
    assert sorted((r.entity, r.raw_value) for r in errors.collect() if r.entity) == [("1", "oops")] and errors.count() == 2
    assert rows(outcomes) == [("1", 2, 1, "failed"), ("2", 1, 0, "loaded")]
