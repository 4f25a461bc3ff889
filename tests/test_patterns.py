"""Texts by pattern and number, and keyed permutations."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from tablewright.functions import patterns
from tablewright.functions.permuting import LARGEST, bases, permuted
from tablewright.operators import generating
from tablewright.rules.generators import GENERATORS

PATTERNS = [s["pattern"] for _, g, s, _, _ in GENERATORS if g == "pattern"] + [
    r"(?:a|bc|)x*[^ -~]?y", r"a|b{2,3}|[x-z\d]+", r"[\]\-a]{2}", r"\w\s?\.", r"(ab?){0,2}", r"[^a-zA-Z]", r"x{2,}?", "",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_strings_match_their_pattern_and_differ(spark, pattern):
    if "[^ -~]" in pattern:
        with pytest.raises(ValueError):
            patterns.tree(r"[^ -~]")
    node, size = patterns.tree(pattern), patterns.size(pattern)
    n = min(size, 400)
    rows = spark.range(n).select(
        "id", patterns.numbered(pattern, F.col("id")).alias("low"), patterns.numbered(pattern, F.lit(size - 1) - F.col("id")).alias("high"),
        patterns.drawn(pattern, "x", F.col("id")).alias("drawn"),
    ).collect()
    for r in rows:
        assert r["low"] == node.text(r["id"]) and r["high"] == node.text(size - 1 - r["id"])
        assert all(re.fullmatch(pattern, r[c]) for c in ("low", "high", "drawn"))
    if pattern != r"(?:a|bc|)x*[^ -~]?y":
        assert len({r["low"] for r in rows}) == n


def test_order_is_by_branch_length_and_last_place():
    assert patterns.strings("b|a") == ["b", "a"]
    assert patterns.strings("[ab]{1,2}") == ["a", "b", "aa", "ab", "ba", "bb"]
    assert patterns.strings(r"x(\.[0-2])?") == ["x", "x.0", "x.1", "x.2"]
    assert patterns.size(r"[A-Z]{2}") == 676 and patterns.size(r"[a-z]{99}") == patterns.LARGEST
    assert patterns.strings(r"[ab][cd]") == ["".join(p) for p in itertools.product("ab", "cd")]


@pytest.mark.parametrize("bad", ["(a", "a)", "[b-a]", "*a", "a{3,2}", "(?=a)", r"\p", "[a"])
def test_what_has_no_strings_is_an_error(bad):
    with pytest.raises(ValueError):
        patterns.tree(bad)


def test_pattern_classes_generate_whole_matches(spark):
    names = [(c, s["pattern"]) for c, g, s, _, _ in GENERATORS if g == "pattern"]
    rows = spark.range(500).select(*[generating.generate_class(c, c, F.col("id")).alias(c) for c, _ in names]).collect()
    for c, pattern in names:
        values = [r[c] for r in rows]
        assert all(re.fullmatch(pattern, v) for v in values), c
        assert len(set(values)) > (300 if c == "STATE" else 495), c
    assert len({len(r["EMAIL"].split("@")[0]) for r in rows}) == 15
    assert all(max(map(int, r["IP_ADDRESS"].split("."))) < 256 for r in rows)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 7919])
def test_permutations_are_one_to_one(spark, size):
    rows = spark.range(size).select(permuted(F.col("id"), size, "k").alias("a"), permuted(F.col("id"), size, "k", "other").alias("b")).collect()
    assert sorted(r["a"] for r in rows) == sorted(r["b"] for r in rows) == list(range(size))
    if size > 90:
        assert sum(r["a"] == r["b"] for r in rows) < size / 10
        moves = [y["a"] - x["a"] for x, y in zip(rows, rows[1:])]
        assert len(set(moves)) > size / 3  # no constant steps


@pytest.mark.parametrize("size", [999001, 10**15, 16**10, 2**48, 665 * 99 * 9999, 10**9 + 7, 999999999989, LARGEST, LARGEST - 93])
def test_bases_fit_every_size(spark, size):
    a, b = bases(size)
    assert a > 1 and 0 <= a * b - size <= 4
    rows = spark.range(200).select(permuted(F.lit(size - 1) - F.col("id"), size, "k").alias("x")).collect()
    assert len({r["x"] for r in rows}) == 200 and all(0 <= r["x"] < size for r in rows)
