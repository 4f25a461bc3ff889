"""op3: toxicity of every text of ``documents``; a fifth of the labels is held out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.shared import query, table
from tablewright.llm.toxicity import score_toxicity


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    scored = score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
