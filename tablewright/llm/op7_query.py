"""op7: ``documents`` in shards of at most 1 MiB of text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.sharding import shard
from tablewright.llm.shared import query, table

LIMIT = 1 << 20

SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h, coalesce(strlen(text), 0) AS n FROM documents),
b(depth, prefix, n) AS (
  SELECT 0, 0::BIGINT, (SELECT sum(n)::BIGINT FROM d)
  UNION ALL
  SELECT p.depth + 1, d.h >> (59 - p.depth), sum(d.n)::BIGINT FROM b p JOIN d ON (d.h >> (60 - p.depth)) = p.prefix
  WHERE p.n > {LIMIT} AND p.depth < 60 GROUP BY 1, 2)
SELECT doc_id, d.n::BIGINT AS n_bytes, depth AS shard_depth, b.n AS shard_bytes,
  CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard
FROM d JOIN b ON (d.h >> (60 - b.depth)) = b.prefix WHERE b.n <= {LIMIT}
"""


@query("op7_extendible_shards", SQL)
def op7_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "coalesce(octet_length(text), 0) AS n_bytes")
    out = shard(docs, "doc_id", docs["n_bytes"], limit=LIMIT)
    return out.select("doc_id", out["n_bytes"].cast("long").alias("n_bytes"), "shard_depth", "shard_bytes", "shard")
