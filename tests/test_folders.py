"""Catalogs of folders that nothing is known of beforehand."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes
from tablewright.operators.versions import current_version
from tablewright.sources import folders


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()
    return str(tmp_path / "in"), str(tmp_path / "store")


def put(root, name, n, **more):
    pq.write_table(pa.table({"id": list(range(n)), "t": [None if i % 2 else f"x{i}" for i in range(n)], **more}), f"{root}/{name}.parquet")


def told(catalog):
    return {r["table_name"]: r for r in catalog.tables.collect()}


def test_five_hundred_small_tables(spark, place):
    root, store = place
    for i in range(500):
        put(root, f"t{i:03d}", i % 7 + 1)
    began = time.time()
    found = told(folders.crawl_folder(spark, root, store))
    first = time.time() - began
    assert len(found) == 500 and all(found[f"t{i:03d}"]["row_count"] == i % 7 + 1 for i in range(500))
    fields = changes.open_table(spark, f"{store}/fields")
    assert fields.count() == 1000
    assert fields.where("field_path = 't'").agg(F.sum("null_count")).first()[0] == sum((i % 7 + 1) // 2 for i in range(500))
    version = current_version(spark, f"{store}/tables")
    began = time.time()
    folders.crawl_folder(spark, root, store)
    assert current_version(spark, f"{store}/tables") == version and time.time() - began < first / 3


def test_only_changed_tables_are_looked_into(spark, place, monkeypatch):
    root, store = place
    for name in "abc":
        put(root, name, 3)
    changes.publish(spark.range(5).withColumn("s", F.struct(F.lit(1).alias("x"))), f"{root}/d")
    spark.range(4).repartition(2).write.parquet(f"{root}/e.parquet")
    before = told(folders.crawl_folder(spark, root, store, views={"few": ("a", "id > 1")}))
    assert {k: (v["row_count"], v["column_count"], v["table_type"]) for k, v in before.items()} == {
        "a": (3, 2, "BASE TABLE"), "b": (3, 2, "BASE TABLE"), "c": (3, 2, "BASE TABLE"), "d": (5, 2, "BASE TABLE"),
        "e": (4, 1, "BASE TABLE"), "few": (1, 2, "VIEW"),
    }
    seen, real = [], folders._look_into
    monkeypatch.setattr(folders, "_look_into", lambda s, n, t, df=None: seen.append(t["table_name"]) or real(s, n, t, df))
    put(root, "b", 9, more=[1.5] * 9)
    put(root, "new", 1)
    changes.publish(spark.range(2), f"{root}/d")
    os.remove(f"{root}/c.parquet")
    after = told(folders.crawl_folder(spark, root, store, views={"few": ("a", "id > 1")}))
    assert sorted(seen) == ["b", "d", "new"]
    assert set(after) == {"a", "b", "d", "e", "few", "new"} and after["b"]["row_count"] == 9 and after["d"]["row_count"] == 2
    fields = changes.open_table(spark, f"{store}/fields")
    assert {r["table_name"] for r in fields.select("table_name").distinct().collect()} == set(after)
    assert {r["field_path"] for r in fields.where("table_name = 'd'").collect()} == {"id"}
    assert after["d"]["file_count"] < 10 and after["b"]["modified"] >= before["b"]["modified"]


def test_comments_ddl_and_times(spark, place):
    root, store = place
    df = spark.sql("SELECT 1L id, named_struct('a', 'x', 'b', array(named_struct('c', 2))) r")
    df = df.select(F.col("id").alias("id", metadata={"comment": "it's the key"}), F.col("r").alias("r", metadata={"comment": "record"}))
    df.write.parquet(f"{root}/odd name")
    found = folders.crawl_folder(spark, root, store, "lake")
    row = told(found)["odd name"]
    assert row["ddl"].startswith("CREATE TABLE lake.odd name (id BIGINT COMMENT 'it''s the key', r STRUCT<") and row["ddl"].endswith("USING parquet")
    assert row["location"] == f"{root}/odd name" and row["created"] <= row["modified"] and row["bytes"] > 0 and row["collation"] == "UTF8_BINARY"
    said = {(r["field_path"], r["description"]) for r in folders.described_fields(found.fields).collect()}
    assert said == {("id", "it's the key"), ("r", "record")}
    schema = folders.schema_details(found.tables).first()
    assert (schema["schema_name"], schema["location"], schema["table_count"], schema["row_count"]) == ("lake", root, 1, 1)
    assert schema["ddl"] == f"CREATE SCHEMA lake LOCATION '{root}'"


def test_an_empty_folder_has_an_empty_catalog(spark, place):
    root, store = place
    assert told(folders.crawl_folder(spark, root, store)) == {}
    put(root, "a", 1)
    assert set(told(folders.crawl_folder(spark, root, store))) == {"a"}
