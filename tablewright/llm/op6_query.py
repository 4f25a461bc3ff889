"""op6: ``documents`` weighed to flattened source, language and form shares, and sampled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.mixing import form_of, mix
from tablewright.llm.shared import query, table


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", form_of(F.col("text")).alias("topic"))
    mixed = mix(docs, topic=F.col("topic"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")
