import pytest
from pyspark.sql import functions as F

from tablewright.operators.changes import open_table, publish
from tablewright.streaming.writes import append_stream, batch_counts, publish_stream, read_files


def write_files(spark, path, low, high):
    for n in range(low, high):
        spark.range(n * 10, n * 10 + 10).select("id", F.col("id").cast("string").alias("t")).coalesce(1).write.mode("append").parquet(path)


def test_append_again_adds_only_new_rows(spark, path):
    write_files(spark, f"{path}/in", 0, 3)
    for files, wanted in ((None, 30), (None, 30), ((3, 5), 50)):
        if files:
            write_files(spark, f"{path}/in", *files)
        stream = read_files(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema, 1)
        append_stream(stream, f"{path}/out", f"{path}/check")
        out = spark.read.parquet(f"{path}/out")
        assert out.count() == wanted and out.distinct().count() == wanted


def test_whole_run_is_published(spark, path):
    write_files(spark, f"{path}/in", 0, 3)
    schema = spark.read.parquet(f"{path}/in").schema
    run = lambda: publish_stream(read_files(spark, f"{path}/in", schema, 1), f"{path}/out", f"{path}/check")
    assert run() == 30 and open_table(spark, f"{path}/out").count() == 30
    assert sorted(tuple(r) for r in batch_counts(spark, f"{path}/out").collect()) == [(0, 10), (1, 10), (2, 10)]
    assert run() == 0 and open_table(spark, f"{path}/out").count() == 30
    write_files(spark, f"{path}/in", 3, 5)
    assert run() == 20 and open_table(spark, f"{path}/out").distinct().count() == 50


def test_failing_batch_publishes_nothing(spark, path):
    write_files(spark, f"{path}/in", 0, 2)
    publish(spark.createDataFrame([(100, 1)], "id long, n int"), f"{path}/out")
    stream = read_files(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema, 1)
    bad = stream.select("id", F.when(F.col("id") < 10, 1).otherwise(F.concat(F.lit("x"), "t").cast("int")).alias("n"))
    with pytest.raises(Exception):
        publish_stream(bad, f"{path}/out", f"{path}/check")
    assert [tuple(r) for r in open_table(spark, f"{path}/out").collect()] == [(100, 1)]
    good = stream.select("id", F.lit(1).alias("n"))
    assert publish_stream(good, f"{path}/out", f"{path}/check") == 20
    assert open_table(spark, f"{path}/out").distinct().count() == 21
