"""Ids, positions and grouping, with one key that holds most rows."""

from pyspark.sql import functions as F

from tablewright.operators import entities, joins, keys


def hot(spark, n=3000):
    """Keys 0..9, where key 7 holds two thirds of the rows; ``o`` orders the rows of a key."""
    return spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 10).cast("int").alias("k"),
        ((F.col("id") * 7919) % n).alias("o"), F.concat(F.lit("v"), "id").alias("v"),
    )


def test_dense_ids_equal_a_plain_count(spark):
    df = hot(spark)
    got = [(r.o, r.seq_id) for r in keys.dense_ids(df, ["o"]).collect()]
    assert sorted(got) == [(o, i + 1) for i, o in enumerate(sorted(r.o for r in df.collect()))]


def test_dense_ids_start_and_step_nulls_and_empty(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "n int")
    assert {r.n: r.i for r in keys.dense_ids(df, ["n"], "i", 100, 10).collect()} == {None: 100, 1: 110, 3: 120}
    assert keys.dense_ids(df.limit(0), ["n"]).count() == 0


def test_dense_ids_have_no_window(spark):
    plan = keys.dense_ids(hot(spark), ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_batches(spark):
    df = spark.range(2500).withColumnRenamed("id", "n")
    for size, wanted in ((0, [1000, 1000, 500]), (2000, [2000, 500])):
        counts = keys.batch_numbers(df, ["n"], size).groupBy("batch_no").count().orderBy("batch_no").collect()
        assert [r["count"] for r in counts] == wanted


def test_positions_of_a_hot_key(spark):
    df = hot(spark)
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r.k, []).append(r.o)
    wanted = {(k, o): i for k, os in by_key.items() for i, o in enumerate(sorted(os))}
    for window_rows in (1_000_000, 500, 1):
        placed = keys.positions(df, ["k"], ["o"], window_rows=window_rows)
        assert {(r.k, r.o): r.position for r in placed.collect()} == wanted


def test_large_keys_come_in_parts_and_whole(spark):
    df = hot(spark).unionByName(spark.createDataFrame([(None, 1, "n1"), (None, 0, "n0")], "k int, o long, v string"))
    got = keys.collect_in_parts(df, ["k"], ["o"], ["v"], "vs", part_rows=150).collect()
    wanted = {}
    for r in sorted(df.collect(), key=lambda r: r.o):
        wanted.setdefault(r.k, []).append(r.v)
    found = {}
    for r in sorted(got, key=lambda r: r.part):
        assert len(r.vs) <= 150
        found.setdefault(r.k, []).extend(x.v for x in r.vs)
    assert found == wanted
    assert {r.part for r in got if r.k == 7} == set(range(-(-len(wanted[7]) // 150)))
    assert {r.part for r in got if r.k is None} == {0}


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None), (None, 1, "n")], "k string, p int, v string")
    got = {r.k: r.v for r in keys.last_wins(df, ["k"], ["p"]).collect()}
    assert got == {"a": "z", "b": None, None: "n"}


def test_documents_with_a_hot_root(spark):
    roots = spark.createDataFrame([(k, f"r{k}") for k in range(12)], "k int, name string")
    docs = entities.assemble(roots, "k", {"rows": (hot(spark), "k", ["o"]), "few": (hot(spark).where("o < 30"), "k", ["o"])}, part_rows=200)
    got = docs.collect()
    counts = {r["k"]: r["count"] for r in hot(spark).groupBy("k").count().collect()}
    for k in range(12):
        mine = [r for r in got if r.k == k]
        assert sum(len(r.rows) for r in mine) == counts.get(k, 0)
        assert all(len(r.rows) <= 200 and r.name == f"r{k}" for r in mine)
    assert sum(len(r.few) for r in got) == 30
    assert [r.rows for r in got if r.k == 11] == [[]]


def test_skewed_join_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        mapping = spark.range(200).select(F.col("id").cast("int").alias("source_value"), (F.col("id") + 1000).cast("int").alias("target_value"))
        df = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 200).cast("int").alias("k"), "id")
        out = joins.replace_keys(df, mapping, "k")
        total = out.agg(F.sum("k").alias("s"), F.count("*").alias("n"))
        row = total.first()
        assert row.n == 60000 and row.s == df.agg(F.sum(F.col("k") + 1000)).first()[0]
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
