from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import casting
from tablewright.functions.types import TYPE_TABLE, source_type, spark_type, type_rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("text, kind, wanted", [
    ("7", "INT64", 7), ("7", "integer", 7), ("1.5", "FLOAT", 1.5), ("true", "boolean", True), ("x", "STRING(10)", "x"),
    ("2020-02-03", "DATE", date(2020, 2, 3)), ("2020-02-03 04:05:06.5", "DATETIME", datetime(2020, 2, 3, 4, 5, 6, 500000)),
    ("1.25", "NUMERIC(10,2)", Decimal("1.250000000")), ("NULL", "INT64", None), ("null", "STRING", None),
])
def test_text_by_type_name(spark, text, kind, wanted):
    assert one(spark, casting.from_text(F.lit(text), kind)) == wanted


def test_unsupported_type_name():
    with pytest.raises(ValueError):
        spark_type("STRUCT")


def test_bad_value_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, casting.from_text(F.lit("x"), "INT64"))


def test_too_many_digits_fail(spark):
    with pytest.raises(Exception):
        one(spark, casting.from_text(F.lit("1" * 39), "BIGNUMERIC"))


@pytest.mark.parametrize("months, days, hours, minutes, seconds, wanted", [
    (14, 3, 4, 5, 6.789, "+1-2 +3 +4:5:6.789"), (-14, -3, -4, -5, -6.5, "-1-2 -3 -4:5:6.500"),
    (0, 0, 0, 0, 0.0, "+0-0 +0 +0:0:0.000"), (5, -1, -2, 0, 0.0, "+0-5 -1 -2:0:0.000"),
])
def test_interval_text(spark, months, days, hours, minutes, seconds, wanted):
    assert one(spark, casting.interval_text(*[F.lit(x) for x in (months, days, hours, minutes, seconds)])) == wanted


def test_epoch_values(spark):
    assert one(spark, casting.from_epoch_days(F.lit(18295))) == date(2020, 2, 3)
    micros = 1580702706123456
    stamp = one(spark, casting.from_epoch_micros(F.lit(micros)))
    assert stamp == datetime(2020, 2, 3, 4, 5, 6, 123456)
    assert one(spark, casting.micros(F.lit(stamp).cast("timestamp_ntz"))) == micros
    assert one(spark, casting.from_epoch_micros(F.lit(-1))) == datetime(1969, 12, 31, 23, 59, 59, 999999)
    assert one(spark, casting.time_of_micros(F.lit(3_723_000_001))) == "01:02:03.000001"


def test_write_matrix(spark):
    df = spark.createDataFrame(
        [(7, 1.5, "x", datetime(2020, 2, 3, 4, 5, 6), bytearray(b"ab"), {"a": 1})],
        "i int, f float, s string, t timestamp_ntz, y binary, m struct<a:int>",
    )
    wanted = [("i", "INT64", 7), ("i", "FLOAT64", 7.0), ("i", "STRING", "7"), ("s", "JSON", "x"), ("m", "JSON", '{"a":1}'),
              ("i", "JSON", "7"), ("y", "BYTES", "YWI="), ("t", "DATETIME", "2020-02-03 04:05:06.000000"),
              ("t", "DATE", "2020-02-03"), ("t", "TIME", "04:05:06.000000"), ("s", "GEOGRAPHY", "x"), ("s", "INTERVAL", "x")]
    for column, kind, value in wanted:
        got = df.select(casting.write_value(F.col(column), df.schema[column].dataType, kind).alias("v")).first().v
        assert got == value, (column, kind)
    for column, kind in [("s", "INT64"), ("s", "FLOAT64"), ("i", "DATE"), ("i", "TIMESTAMP"), ("s", "NUMERIC")]:
        with pytest.raises(TypeError):
            casting.write_value(F.col(column), df.schema[column].dataType, kind)


def test_decimal_class():
    assert casting.decimal_class(T.DecimalType(20, 9)) == "NUMERIC"
    assert casting.decimal_class(T.DecimalType(20, 10)) == "BIGNUMERIC"


def test_plain_decimal_has_no_exponent(spark):
    assert one(spark, casting.plain_decimal(F.lit(Decimal("0.0000000000010")).cast("decimal(20,13)"))) == "0.0000000000010"


def test_records_by_name_nested_and_in_arrays(spark):
    have = "r struct<b:string,extra:int,in:array<struct<x:string,y:int>>>"
    df = spark.createDataFrame([(("5", 1, [("1", 2), (None, 3)]),), (None,)], have)
    want = T.StructType([T.StructField("r", T.StructType([
        T.StructField("b", T.LongType()), T.StructField("gone", T.StringType()),
        T.StructField("in", T.ArrayType(T.StructType([T.StructField("x", T.IntegerType())]))),
    ]))])
    rows = casting.fit_to_schema(df, want).collect()
    assert rows[0].r.asDict(True) == {"b": 5, "gone": None, "in": [{"x": 1}, {"x": None}]}
    assert rows[1].r is None


def test_unknown_column_is_an_error(spark):
    with pytest.raises(ValueError, match="zzz"):
        casting.fit_to_schema(spark.createDataFrame([(1, 2)], "a int, zzz int"), T.StructType([T.StructField("a", T.IntegerType())]))


def test_not_an_array_is_an_error(spark):
    want = T.StructType([T.StructField("a", T.ArrayType(T.IntegerType()))])
    with pytest.raises(TypeError):
        casting.fit_to_schema(spark.createDataFrame([(1,)], "a int"), want)


def test_merge_later_wins_even_when_null(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    row = casting.merge_records(df, [{"a": F.col("a"), "b": F.col("b")}, {"A": F.lit(None).cast("int")}], ignore_case=True)
    assert row.columns == ["a", "b"] and tuple(row.first()) == (None, 2)
    assert casting.merge_records(df, [{"a": F.col("a")}, {"A": F.lit(9)}]).columns == ["a", "A"]


def test_entity_id_classes(spark):
    assert one(spark, casting.entity_id(F.lit("5"), "integer")) == 5
    assert one(spark, casting.entity_id(F.lit("5.5"), "REAL")) == 5.5
    assert one(spark, casting.entity_id(F.lit(5), "TEXT")) == "5"
    assert one(spark, casting.entity_id(F.lit("x"), "SOMETHING")) == "x"


def test_type_table(spark):
    assert len(TYPE_TABLE) == 17 and type_rows(spark).count() == 17
    assert source_type(T.ArrayType(T.ArrayType(T.LongType()))) == "REPEATED INT64"
    assert source_type(T.StructType([T.StructField("start", T.DateType()), T.StructField("end", T.DateType())])) == "RANGE"


def test_zoneless_times_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = F.lit("2024-03-10 02:30:00.25").cast("timestamp_ntz")  # an hour this zone skips
        assert one(spark, casting.datetime_text(gap, T.TimestampNTZType())) == "2024-03-10 02:30:00.250000"
        assert one(spark, casting.time_text(gap, T.TimestampNTZType())) == "02:30:00.250000"
        assert one(spark, casting.micros(gap)) == 1710037800250000
        assert one(spark, casting.micros(F.lit("1969-12-31 23:59:59.999999").cast("timestamp_ntz"))) == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
