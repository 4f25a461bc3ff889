"""op13: the prefix trie of ``conversations`` that share first turns with the first of their five."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.prefix_trie import numbered_turns, prefix_trie
from tablewright.llm.shared import query, stored, table

CHECK = """
WITH bits AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS row
), placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, row[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM placed), bits
), rebuilt AS (
    SELECT c.conv_id, 0 AS own, p.pos, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.base AND p.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, p.pos, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos >= c.h
), whole AS (
    SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.own, r.pos) FILTER (r.own IS NOT NULL), []) AS turns
    FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), prefixes AS (
    SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM whole
), nodes AS (
    SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) > depth AS goes_on,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
        CASE WHEN depth = 0 THEN 0 ELSE strlen(turns[1:depth][depth].text) END AS size
    FROM prefixes GROUP BY depth, turns[1:depth]
)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs,
    (SELECT count(*) FROM nodes c WHERE c.depth = a.depth + 1 AND c.path[1:a.depth] = a.path)::BIGINT AS n_children,
    (SELECT count(*) FROM nodes c WHERE c.depth >= a.depth AND c.path[1:a.depth] = a.path AND NOT c.goes_on)::BIGINT AS n_leaves,
    (SELECT sum((c.n_convs - 1) * c.size) FROM nodes c WHERE c.depth >= a.depth AND c.path[1:a.depth] = a.path)::BIGINT AS saved_tokens,
    a.ends_sha256
FROM nodes a LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.path = a.path[1:a.depth - 1]
"""


def rebuilt(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The first h turns of the conversation whose id is the next multiple of five towards 0, then what follows the own first h."""
    convs = members.select("conv_id", F.expr("conv_id - conv_id % 5").alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h"))
    heads = turns.where("pos < 8")
    held = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("there"))
    convs = convs.join(held, "base", "left").withColumn("there", F.least("h", F.coalesce("there", F.lit(0))))
    first = heads.withColumnRenamed("conv_id", "base").join(convs, "base").where("pos < h").select("conv_id", "pos", "key", "size")
    own = turns.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("there")).alias("pos"), "key", "size")
    return first.unionByName(own)


@query("op13_prefix_trie", CHECK)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(numbered_turns(table(spark, sf_dir, "conversations")), "trie-turns")
    members = turns.select("conv_id").distinct()
    return prefix_trie(rebuilt(turns, members), members)
