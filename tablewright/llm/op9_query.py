"""op9: ``documents`` packed into sequences of 2048 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.packing import pack
from tablewright.llm.shared import query, table


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")
