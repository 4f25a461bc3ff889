import pytest
from pyspark.sql import functions as F

from tablewright.operators import joins
from tablewright.operators.filters import pieces, typed_filter
from tablewright.sources import tables
from tablewright.sources.tables import load


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_columns_no_filter_no_limit_mean_everything(spark, data):
    df = tables.read_table(spark, data, "orders")
    assert df.columns == load(spark, data, "orders").columns
    assert df.count() == load(spark, data, "orders").count()
    assert tables.take(df, -3).count() == df.count()


def test_filter_and_columns_reach_the_scan(spark, data):
    df = tables.read_table(spark, data, "orders", ["o_orderkey"], "o_totalprice > 1000")
    text = plan(df)
    assert "GreaterThan(o_totalprice,1000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_bound_text_reaches_the_scan_as_a_typed_value(spark, data):
    df = typed_filter(load(spark, data, "orders"), "o_totalprice > ? and o_orderkey = ?", [("o_totalprice", "1000"), ("o_orderkey", "7")])
    text = plan(df.select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in text and "EqualTo(o_orde" in text


@pytest.mark.parametrize("value", ["50% and $100", "$ off today", "C:\\temp\\file", "it's", "?"])
def test_special_characters_are_plain(spark, value):
    df = spark.createDataFrame([(value, 1), ("other", 2)], "a string, n int")
    assert [r.n for r in typed_filter(df, "a = ?", [("a", value)]).collect()] == [1]


def test_mark_count_must_match(spark):
    df = spark.createDataFrame([("x", 1)], "a string, n int")
    with pytest.raises(ValueError, match="not enough"):
        typed_filter(df, "a = ? and n = ?", [("a", "x")])
    with pytest.raises(ValueError, match="too many"):
        typed_filter(df, "a = ?", [("a", "x"), ("n", "1")])
    assert pieces("a = '?' and b = ?") == ["a = '?' and b = ", ""]
    assert pieces("a = 'it\\'s ?' and \"?\" = b and `?` = ? or ? = c") == ["a = 'it\\'s ?' and \"?\" = b and `?` = ", " or ", " = c"]


def test_braces_in_the_filter_are_plain(spark):
    df = spark.createDataFrame([("xx", 1), ("x", 2)], "a string, n int")
    assert typed_filter(df, "a rlike '^x{2}$' and n > ?", [("n", "0")]).count() == 1
    assert typed_filter(df, "a rlike '^x{2}$'", []).count() == 1


def test_null_text_binds_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    assert typed_filter(df, "n = ?", [("n", "NULL")]).count() == 0
    assert typed_filter(df, "n <=> ?", [("n", None)]).count() == 1


def test_bad_number_text_fails(spark):
    df = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed_filter(df, "n = ?", [("n", "abc")]).collect()


@pytest.mark.parametrize("count, smallest, largest, wanted", [(15, 10, 1000, 10), (500, 10, 1000, 250), (2000, 10, 1000, 1000), (1999, 10, 1000, 999)])
def test_sample_size(spark, count, smallest, largest, wanted):
    size = spark.range(1).select(tables.sample_size(F.lit(count), 50, smallest, largest)).first()[0]
    assert size == wanted


@pytest.mark.parametrize(
    "text",
    [
        "SELECT * FROM t", "SELECT * FROM t;", "SELECT * FROM t LIMIT 500", "SELECT 'limit 5' AS x, n FROM t",
        "WITH a AS (SELECT * FROM t) SELECT * FROM a", "SELECT * FROM t -- note; more\n", "SELECT /* ; */ * FROM t",
    ],
)
def test_cap_holds_for_every_query(spark, text):
    spark.range(2000).withColumnRenamed("id", "n").createOrReplaceTempView("t")
    assert tables.run_capped(spark, text, 7).count() == 7
    assert tables.run_capped(spark, text, 0).count() == 0
    assert tables.run_capped(spark, text).count() == (500 if "LIMIT 500" in text else 1000)


def test_lists(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    assert joins.in_list(df, "c", []).count() == 0
    assert joins.not_in_list(df, "c", []).count() == 3
    for listed in (["a"], frame("a", "a")):
        assert [r.c for r in joins.in_list(df, "c", listed).collect()] == ["a"]
        assert [r.c for r in joins.not_in_list(df, "c", listed).collect()] == ["b"]
    assert {r.c for r in joins.scope(df, "c", frame("a", "b"), frame("a")).collect()} == {"b"}
    assert {r.c for r in joins.scope(df, "c", frame(), frame("a")).collect()} == {"b"}


def test_namespace_mark_in_text_is_left_alone(spark):
    spark.range(3).createOrReplaceGlobalTempView("numbers")
    row = tables.in_namespace(spark, "global_temp", "SELECT '$ns.t' AS s, count(*) AS n FROM IDENTIFIER(:ns || '.numbers') WHERE id > :low", low=0).first()
    assert (row.s, row.n) == ("$ns.t", 2)


def test_settings_fall_back_to_the_default(spark):
    settings = spark.createDataFrame([("", "a", 1), ("x", "b", None)], "name string, step string, level int")
    items = spark.createDataFrame([("x",), ("y",)], "name string")
    assert sorted(tuple(r) for r in tables.pick_settings(items, settings, "name").collect()) == [("x", "b", 1), ("y", "a", 1)]


def test_generated_names(spark):
    rows = tables.numbered_rows(spark, 50).select(F.format_string("baby_%d", "i").alias("name"), "i").collect()
    assert len(rows) == 50 and rows[0].name == "baby_0" and rows[49].name == "baby_49"


def test_query_result_types(spark):
    df = tables.run_sql(spark, "SELECT ? AS name, cast(? AS BIGINT) AS age", ["Alice", 30])
    assert df.dtypes == [("name", "string"), ("age", "bigint")] and tuple(df.first()) == ("Alice", 30)
