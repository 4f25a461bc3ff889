"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of an edge (a, b); the label is the smallest node of its component.

    Each step is a grouped minimum and a join back in which the edges are the side that may be
    cut up, so a node with very many neighbours does not stay in one task. Each state is written out;
    only a count and a checksum reach the driver. The steps end when nothing changes, after
    about log squared of the number of nodes at worst and two or three steps for stars.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.union(now.groupBy("u").agg(F.min("v").alias("v"))).distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.union(low).distinct(), "small-star")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
