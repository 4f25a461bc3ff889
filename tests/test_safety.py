"""Writes that must not lose, mix up or overwrite rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import joins, masking
from tablewright.operators.changes import (
    PublishError, current_version, load_with_errors, open_table, publish, run_by_level, show, split_errors, stage, upsert,
)
from tablewright.streaming.writes import batch_counts, publish_stream, read_files


def test_error_split_matches_names_and_depth(spark):
    target = T.StructType.fromDDL("id long, v int, r struct<a: int, b: int>")
    df = spark.sql("SELECT 1L id, '5' V, named_struct('b', '2', 'a', '1') r UNION ALL SELECT 2L, '6', named_struct('b', 'x', 'a', '1')")
    good, bad = split_errors(df, target)
    assert [tuple(r) for r in good.collect()] == [(1, 5, (1, 2))]
    assert [r["column_name"] for r in bad.collect()] == ["r"]
    with pytest.raises(ValueError, match="extra"):
        split_errors(df.withColumn("extra", F.lit("lost")), target)


def test_both_sides_of_a_load_show(spark, path):
    df = spark.createDataFrame([(1, "5"), (2, "x")], "id long, v string")
    assert load_with_errors(df, T.StructType.fromDDL("id long, v int"), f"{path}/good", f"{path}/bad") == (1, 1)
    assert open_table(spark, f"{path}/good").collect() == [(1, 5)] and open_table(spark, f"{path}/bad").count() == 1


def test_only_one_writer_follows_a_version(spark, path):
    publish(spark.range(3), path)
    version = current_version(spark, path)
    mine, yours = stage(spark.range(5), path)[0], stage(spark.range(2), path)[0]
    show(spark, path, [mine], version)
    with pytest.raises(PublishError):
        show(spark, path, [yours], version)
    assert open_table(spark, path).count() == 5


def test_upsert_compares_stored_keys(spark, path):
    publish(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), path)
    with pytest.raises(ValueError):
        upsert(spark, path, spark.createDataFrame([("2", "c"), ("02", "d")], "k string, v string"), ["k"])
    assert upsert(spark, path, spark.createDataFrame([("1", "c"), ("2", "d")], "k string, v string"), ["k"]) == {"matched": 1, "inserted": 1}


def test_streamed_rows_are_fitted(spark, path):
    publish(spark.createDataFrame([(1,)], "id long"), f"{path}/out")
    spark.createDataFrame([("7",)], "id string").write.parquet(f"{path}/in")
    schema = T.StructType.fromDDL("id string")
    with pytest.raises(ValueError):
        publish_stream(read_files(spark, f"{path}/in", schema).withColumn("more", F.lit(1)), f"{path}/out", f"{path}/check1")
    assert publish_stream(read_files(spark, f"{path}/in", schema), f"{path}/out", f"{path}/check2") == 1
    assert sorted(r["id"] for r in open_table(spark, f"{path}/out").collect()) == [1, 7]
    publish_stream(read_files(spark, f"{path}/in", schema), f"{path}/out", f"{path}/check3")
    assert [tuple(r) for r in batch_counts(spark, f"{path}/out").collect()] == [(0, 1), (0, 1)]


def test_lists_and_frames_agree(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    for values, wanted in ((["a", None], ["b"]), ([], ["a", "b", None]), ([None], ["a", "b", None])):
        frame = spark.createDataFrame([(v,) for v in values], "c string")
        assert [r["c"] for r in joins.not_in_list(df, "c", values).collect()] == wanted
        assert sorted((r["c"] for r in joins.not_in_list(df, "c", frame).collect()), key=str) == sorted(wanted, key=str)


def test_falling_sequence_never_repeats(spark, path):
    for keys in ([(1,), (2,)], [(3,), (4,)]):
        out = masking.extend_mapping(spark, path, spark.createDataFrame(keys, "k int"), "k", 10, -1)
    assert sorted(r["target_value"] for r in out.collect()) == [7, 8, 9, 10]


def test_wordless_failure_is_reported(spark):
    def fail():
        raise RuntimeError

    assert [r["message"] for r in run_by_level(spark, [{"t": fail}]).collect()] == ["RuntimeError"]
