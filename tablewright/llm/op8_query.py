"""op8: near duplicates among ``documents`` on shingles of two words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.minhash_tensor import near_duplicates
from tablewright.llm.shared import query, table


@query("op8_minhash_tensor")
def op8_minhash_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
