"""op1: the 20 best partners of every twentieth vector of ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.shared import query, stored, table
from tablewright.llm.topk_pivots import integer_vectors, top_k

SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op1_topk_pivots", SQL)
def op1_topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = stored(integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64), "vectors")
    return top_k(points, points.where("id % 20 = 0"), 20)
