"""Queries of the subpackage against the SQL that states them."""

import duckdb
import pytest

from tablewright.llm.queries import CHECKS, QUERIES

TABLES = ("documents", "embeddings", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_its_check(spark, data, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{data}/{table}.parquet')")
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    result = con.execute(CHECKS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == wanted
