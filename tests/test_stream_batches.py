"""Streamed batches beside rows written otherwise, and batches that Spark repeats."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes
from tablewright.sources import files
from tablewright.streaming import writes
from tablewright.streaming.writes import append_stream, batch_counts, publish_stream, read_files


def put(spark, path, *rows):
    spark.createDataFrame(list(rows), "k long, v string").coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return read_files(spark, path, spark.read.parquet(path).schema, 1)


def read(spark, path):
    table = changes.open_table(spark, path) if changes.current_version(spark, path) else spark.read.parquet(path)
    return sorted((r["k"], r["v"]) for r in table.collect())


@pytest.mark.parametrize("published", [True, False])
def test_a_stream_lives_beside_batches(spark, path, published):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    (changes.publish if published else changes.append)(first, f"{path}/t")
    put(spark, f"{path}/in", (3, "c"), (4, "d"))
    put(spark, f"{path}/in", (5, "e"))
    assert append_stream(stream(spark, f"{path}/in"), f"{path}/t", f"{path}/c", run="one") == 3
    five = [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert read(spark, f"{path}/t") == five
    assert append_stream(stream(spark, f"{path}/in"), f"{path}/t", f"{path}/c", run="one") == 0
    (changes.publish_more if published else changes.append)(spark.createDataFrame([(6, "f")], "k int, v string"), f"{path}/t")
    put(spark, f"{path}/in", (7, "g"))
    assert append_stream(stream(spark, f"{path}/in"), f"{path}/t", f"{path}/c") == 1
    assert read(spark, f"{path}/t") == [*five, (6, "f"), (7, "g")]
    put(spark, f"{path}/more", (8, "h"))
    assert append_stream(stream(spark, f"{path}/more"), f"{path}/t", f"{path}/c2", run="two") == 1
    counts = sorted(tuple(r) for r in batch_counts(spark, f"{path}/t", ["one", "two"]).collect())
    assert [c for c in counts if c[0] == "two"] == [("two", 0, 1)]
    assert [c[1] for c in counts if c[0] == "one"] == [0, 1, 2] and sum(c[2] for c in counts) == 5
    assert dict(spark.read.parquet(f"{path}/in").dtypes)["k"] == "bigint"
    stored = changes.open_table(spark, f"{path}/t") if published else spark.read.parquet(f"{path}/t")
    assert dict(stored.dtypes)["k"] == "int"


@pytest.mark.parametrize("published", [True, False])
def test_unknown_columns_are_an_error_before_reading(spark, path, published):
    (changes.publish if published else changes.append)(spark.createDataFrame([(1,)], "k long"), f"{path}/t")
    put(spark, f"{path}/in", (3, "c"))
    with pytest.raises(ValueError, match="v"):
        append_stream(stream(spark, f"{path}/in"), f"{path}/t", f"{path}/c")
    with pytest.raises(ValueError, match="letters"):
        append_stream(stream(spark, f"{path}/in").drop("v"), f"{path}/t", f"{path}/c", run="a/b")
    assert append_stream(stream(spark, f"{path}/in").drop("v"), f"{path}/t", f"{path}/c", run="a") == 1
    with pytest.raises(ValueError, match="run a"):
        append_stream(stream(spark, f"{path}/in").drop("v"), f"{path}/t", f"{path}/c", run="b")


@pytest.mark.parametrize("published", [True, False])
@pytest.mark.parametrize("when", ["staged", "shown"])
def test_a_repeated_batch_counts_once(spark, path, published, when, monkeypatch):
    """The driver is lost between the write of a batch and the moment Spark notes it."""
    (changes.publish if published else changes.append)(spark.createDataFrame([(1, "a")], "k long, v string"), f"{path}/t")
    for n in range(2, 5):
        put(spark, f"{path}/in", (n, "x"))
    real = files.read_text
    if when == "staged":
        name, where = ("show_more", writes) if published else ("move", files)

        def lost(*args):
            raise RuntimeError("driver lost")

        monkeypatch.setattr(where, name, lost)
    else:
        def lost_after(spark_, place):
            if "/_b-000000001" in place:
                raise RuntimeError("driver lost")
            return real(spark_, place)

        monkeypatch.setattr(files, "read_text", lost_after)
    with pytest.raises(Exception, match="driver lost"):
        append_stream(stream(spark, f"{path}/in"), f"{path}/t", f"{path}/c")
    monkeypatch.undo()
    append_stream(stream(spark, f"{path}/in"), f"{path}/t", f"{path}/c")
    assert read(spark, f"{path}/t") == [(1, "a"), (2, "x"), (3, "x"), (4, "x")]


def test_a_failing_batch_leaves_the_earlier_ones(spark, path):
    changes.append(spark.createDataFrame([(1, 1)], "k long, n int"), f"{path}/t")
    put(spark, f"{path}/in", (2, "2"))
    put(spark, f"{path}/in", (3, "x"))
    rows = stream(spark, f"{path}/in").select("k", F.col("v").alias("n"))
    with pytest.raises(Exception):
        append_stream(rows, f"{path}/t", f"{path}/c")
    found = {r["k"] for r in spark.read.parquet(f"{path}/t").collect()}
    assert 1 in found and 3 not in found


def test_a_whole_run_joins_what_others_published_meanwhile(spark, path, monkeypatch):
    changes.publish(spark.createDataFrame([(1, "a")], "k long, v string"), f"{path}/t")
    put(spark, f"{path}/in", (2, "b"))
    real = writes.write_checked

    def slow(df, place):
        changes.publish_more(spark.createDataFrame([(9, "z")], "k long, v string"), f"{path}/t")
        return real(df, place)

    monkeypatch.setattr(writes, "write_checked", slow)
    assert publish_stream(stream(spark, f"{path}/in"), f"{path}/t", f"{path}/c") == 1
    assert read(spark, f"{path}/t") == [(1, "a"), (2, "b"), (9, "z")]
