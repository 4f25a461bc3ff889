"""Every registered query against its plain-SQL check."""

import math

import pytest

import __spark_entry__ as entry_points
from tablewright.plans import CHECKS, QUERIES as MADE
from tablewright.plans.tables import TABLES

duckdb = pytest.importorskip("duckdb")
QUERIES = {name: make for name, make in entry_points.queries().items() if name in MADE}

SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def engine(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, data, engine, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    found = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = engine.execute(CHECKS[name])
    described = {d[0]: str(d[1]).upper() for d in result.description}
    order = [list(described).index(c) for c in columns]
    wanted = sorted((tuple(_plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    assert sorted(described) == columns
    assert found == wanted
    kinds = {f.name: SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert {c: kinds[c] for c in columns} == {c: described[c] for c in columns}


def test_every_query_has_a_check():
    assert set(CHECKS) == set(QUERIES)


def test_plans_have_no_cross_join(spark, data):
    for name, make in QUERIES.items():
        plan = make(spark, data)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas"):
            assert word not in plan, f"{name}: {word}"


def test_entry_gives_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["o_orderkey", "my_name", "o_totalprice"]
    assert df.count() > 0
