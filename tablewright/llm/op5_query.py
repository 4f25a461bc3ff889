"""op5: bytes of ``documents`` that stand in strings of 200 bytes found elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.shared import query, table
from tablewright.llm.suffix_dedup import remove_repeats


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
