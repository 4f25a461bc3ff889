"""Stored sequences by scope, types of text, task tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tablewright.operators import entities, masking, profiling, sequences
from tablewright.operators.changes import open_table, publish
from tablewright.operators.versions import current_version


def numbers(df, scope="s"):
    return {(r[scope], r["source_value"]): r["target_value"] for r in df.collect()}


def test_each_scope_counts_for_itself_and_old_rows_stay(spark, path):
    one = spark.createDataFrame([("a", 5), ("a", 3), ("b", 3), (None, 3), ("a", None), ("a", 5)], "s string, k int")
    first = numbers(masking.extend_mapping(spark, path, one, "k", 10, 5, scope=["s"]))
    assert first == {("a", 3): 10, ("a", 5): 15, ("b", 3): 10, (None, 3): 10}
    version = current_version(spark, path)
    two = spark.createDataFrame([("a", 1), ("b", 3), ("c", 9), (None, 4)], "s string, k int")
    second = numbers(masking.extend_mapping(spark, path, two, "k", 10, 5, scope=["s"]))
    assert second == first | {("a", 1): 20, ("c", 9): 10, (None, 4): 15}
    assert current_version(spark, path).startswith(version + "\n")
    third = numbers(masking.extend_mapping(spark, path, two, "k", 10, 5, scope=["s"]))
    assert third == second and current_version(spark, path).count("\n") == 1


def test_interleaved_runs_never_share_a_number(spark, path, monkeypatch):
    """The second run reads, claims and stores while the first is between its claim and its rows."""
    real, done = sequences.claim, []

    def claim(spark_, place, wanted):
        out = real(spark_, place, wanted)
        if not done:
            done.append(True)
            other = spark.createDataFrame([("a", 2), ("a", 3), ("b", 7)], "s string, k int")
            masking.extend_mapping(spark, path, other, "k", scope=["s"])
        return out

    monkeypatch.setattr(sequences, "claim", claim)
    mine = spark.createDataFrame([("a", 1), ("a", 2), ("b", 8)], "s string, k int")
    found = masking.extend_mapping(spark, path, mine, "k", scope=["s"]).collect()
    keys = [(r["s"], r["source_value"]) for r in found]
    assert sorted(keys) == [("a", 1), ("a", 2), ("a", 3), ("b", 7), ("b", 8)]
    assert len({(r["s"], r["target_value"]) for r in found}) == 5


def test_many_runs_at_once(spark, path):
    def run(n):
        df = spark.range(n * 10, n * 10 + 25).withColumn("s", F.col("id") % 2)
        masking.extend_mapping(spark, path, df, "id", scope=["s"])

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(run, range(3)))
    rows = open_table(spark, path).collect()
    assert len(rows) == len({(r["s"], r["source_value"]) for r in rows}) == len({(r["s"], r["target_value"]) for r in rows}) == 45


def test_a_mapping_without_claims_goes_on_after_its_last_number(spark, path):
    publish(spark.createDataFrame([(5, 1), (7, 2)], "source_value int, target_value long"), path)
    out = masking.extend_mapping(spark, path, spark.createDataFrame([(9,), (5,)], "k int"), "k")
    assert {r["source_value"]: r["target_value"] for r in out.collect()} == {5: 1, 7: 2, 9: 3}


def test_audit_keeps_the_scope(spark, path):
    df = spark.createDataFrame([("a", 5), ("b", 5)], "s string, k int")
    mapping = masking.extend_mapping(spark, path, df, "k", scope=["s"])
    rows = masking.audit_rows(df, mapping, "t", "k", "q", "run", "unit").collect()
    assert sorted((r["s"], r["source_value"], r["target_value"]) for r in rows) == [("a", "5", "1"), ("b", "5", "1")]


TEXTS = {
    "INT64": ["1", "-9223372036854775808", " 7 ", None], "NUMERIC": ["0.123456789", "12345678901234567890123456789", "-.5", "1."],
    "BIGNUMERIC": ["0.12345678901234", "5", "1.500000000000000000"], "FLOAT64": ["1.5e3", "0.25", "NaN", "-inf"], "BOOL": ["true", "N", "0"],
    "DATE": ["2024-02-29", "1999-01-01"], "DATETIME": ["2024-02-29 01:02:03.5", "2024-01-01"], "STRING": ["x", "1"],
}


def test_no_type_loses_a_digit(spark):
    rows = [tuple(TEXTS[c][i] if i < len(TEXTS[c]) else None for c in TEXTS) for i in range(4)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in TEXTS))
    found = {r["column_name"]: r for r in profiling.text_types(profiling.text_state(df)).collect()}
    assert {c: r["inferred_type"] for c, r in found.items()} == {c: c for c in TEXTS}
    assert found["BIGNUMERIC"]["spark_type"] == "decimal(38,14)"
    more = {
        "too_many": (["1" * 30 + "." + "1" * 9], "STRING"), "wide": (["1" * 30], "BIGNUMERIC"), "beyond": (["1" * 39], "STRING"),
        "digits": (["1.23456789012345678", "1e3"], "STRING"), "not_a_day": (["2024-02-30"], "STRING"), "none": ([None], "STRING"),
        "big": (["9223372036854775808"], "NUMERIC"), "leading": (["000000000000000000000000000000000000000000001"], "INT64"),
    }
    for name, (values, wanted) in more.items():
        one = spark.createDataFrame([(v,) for v in values], "c string")
        assert profiling.infer_text_types(one).first()["inferred_type"] == wanted, name


def test_states_of_parts_merge_to_the_state_of_the_whole(spark):
    df = spark.range(60).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise(F.concat("id", F.lit("."), F.col("id") * 1000003)).alias("a"),
        F.when(F.col("id") < 59, "true").alias("b"),
    )
    parts = [profiling.text_state(p) for p in df.randomSplit([1.0, 2.0, 3.0], 5)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    merged = profiling.merge_text_states(whole)
    key = lambda d: sorted(tuple(r[c] for c in ("column_name", *profiling.TEXT_STATE)) for r in d.collect())
    assert key(merged) == key(profiling.text_state(df))


def test_typed_texts_keep_every_value(spark):
    df = spark.createDataFrame([("0.12345678901234", "x"), ("7", None)], "n string, s string")
    out = profiling.typed_texts(df, profiling.text_state(df))
    assert out.dtypes == [("n", "decimal(38,14)"), ("s", "string")]
    assert sorted(str(r["n"]) for r in out.collect()) == ["0.12345678901234", "7.00000000000000"]


SETTINGS = "table_name string, extract_step string, delete_step string, load_step string, count_step string, table_order int"


def test_settings_choose_the_steps(spark, path):
    settings = spark.createDataFrame(
        [("", "extract_by_query", None, "load_atomic", None, 1), ("b", "whole", "truncate", "load_replace", "count_none", 0), ("c", "extract_by_scan", "delete_all", "load_batched", None, 2)],
        SETTINGS,
    )
    frames = {n: spark.range(10).toDF("n") for n in "abc"}
    filters = {"a": ("n >= ?", [("n", "6")]), "b": ("n >= ?", [("n", "6")]), "c": ("n < 3", [])}
    for turn in (1, 2):
        status = entities.run_tasks(spark, frames, settings, path, filters=filters).collect()
        assert [(r["level"], r["table_name"], r["status"], r["row_count"]) for r in status] == [(0, "b", "done", 10), (1, "a", "done", 4), (2, "c", "done", 3)]
        counts = {n: entities.open_loaded(spark, f"{path}/{n}").count() for n in frames}
        assert counts == {"a": 4 * turn, "b": 10, "c": 3 * turn}


@pytest.mark.parametrize("column", ["extract_step", "delete_step", "load_step", "count_step"])
def test_an_unknown_step_stops_the_run_before_it_begins(spark, path, column):
    row = {"table_name": "", "extract_step": "whole", "delete_step": "delete_none", "load_step": "publish", "count_step": "count_where", "table_order": 1}
    good = spark.createDataFrame([tuple(row.values()), ("bad", *[("nonsense" if c == column else None) for c in list(row)[1:-1]], 9)], SETTINGS)
    with pytest.raises(ValueError, match="nonsense"):
        entities.run_tasks(spark, {"good": spark.range(2), "bad": spark.range(2)}, good, path)
    assert current_version(spark, f"{path}/good") is None


def test_a_failed_level_stops_the_next(spark, path):
    settings = spark.createDataFrame([("", "typed", None, "publish", None, 1), ("late", None, None, None, None, 2)], SETTINGS)
    frames = {"early": spark.range(2), "late": spark.range(2)}
    status = entities.run_tasks(spark, frames, settings, path, filters={"early": ("id / (id - id) > 1", [])}).collect()
    assert [(r["table_name"], r["status"]) for r in status] == [("early", "failed"), ("late", "skipped")]


ODD = [
    "1", "-0", "+007", "12\n", "1.50\n", "100", "100.", "100.50", "0.0", "0.00123", ".5", "1e5", "1.50E-3f", "2d", "1F", "nan", "-Inf", "+infinity", "", " ",
    "9223372036854775807", "9223372036854775808", "-9223372036854775808", "1" * 25, "0" * 30 + "7", "1.2.3", "e5", "true", "No\n", "truest", "2024", "-2024-01-01",
    "2024-01-01", "2024-13-01", "2024-01-01\n", "2024-01-01 10:00:00", "24-1", "1 ", "١", "12 3", "--1", "x" * 300, None,
]


def test_a_text_is_matched_once_and_counted_as_the_shapes_say(spark):
    import re

    df = spark.createDataFrame([tuple(ODD)], ", ".join(f"c{i} string" for i in range(len(ODD))))
    states = {r["column_name"]: r for r in profiling.text_state(df).collect()}
    for i, v in enumerate(ODD):
        found = states[f"c{i}"]
        t = None if v is None else v.strip(" ")
        is_a = lambda shape: t is not None and re.search(re.sub(r"\$", "(?=[\n ]?\\\\Z)", shape), t, re.A) is not None  # noqa: E731, B023
        plain, floats = is_a(profiling.PLAIN), is_a(profiling.FLOAT)
        number = lambda pattern: re.sub("[.]", "", re.search(pattern, t.strip("\n "))[1])  # noqa: E731, B023
        assert found["values"] == (v is not None) and found["whole"] == is_a(profiling.WHOLE), v
        assert (found["plain"], found["floats"], found["bools"]) == (plain, floats, is_a(profiling.BOOL)), v
        assert found["longs"] == (found["whole"] and " " not in t and -(1 << 63) <= int(t) < 1 << 63), v
        assert found["dates"] == (v in ("2024-01-01", "2024-01-01\n")), v
        assert found["times"] == (v in ("2024", "-2024-01-01", "2024-01-01", "2024-01-01\n", "2024-01-01 10:00:00")), v
        assert found["whole_digits"] == (len(number("^[+-]?0*([0-9]*)")) if plain else 0), v
        assert found["decimals"] == (len(number("[.]([0-9]*?)0*$")) if plain and "." in t else 0), v
        real = floats and not re.search("[nN]", t)
        assert found["float_digits"] == (len(number("^[+-]?0*([0-9.]*?)0*(?:[eEfFdD]|$)")) if real else 0), v
    wide = spark.createDataFrame([("1",) * 7], ", ".join(f"c{i} string" for i in range(7)))
    plan = lambda d: profiling.text_state(d)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")
    assert plan(wide) == plan(wide.select("c0")) <= 6


def test_number_types_are_measured_in_one_pass(spark, data):
    from tablewright.plans import QUERIES

    found = QUERIES["infer_number_types"](spark, data)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey#") <= 10
    assert found._jdf.queryExecution().toString().count("lineitem.parquet") <= 2
