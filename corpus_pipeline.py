"""A corpus pipeline of five stages; each takes what the one before kept.

Stages return the columns of ``documents`` (the last one pieces of packed sequences). Each result is
written as Parquet and read again, so a lost executor never reaches back past its stage.

Nulls, empty texts, repeated rows and empty tables behave as the operators define; rows without
a text fail the quality rules. Rows that repeat an id are one document: they stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.minhash_tensor import near_duplicates
from tablewright.llm.mixing import mix
from tablewright.llm.packing import pack
from tablewright.llm.quality_lines import kept_only, quality_rules
from tablewright.llm.secret_scans import redacted
from tablewright.llm.shared import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others, the lines that failed go."""
    kept = kept_only(quality_rules(docs.select(*COLUMNS))).withColumn("text", F.col("quality.text"))
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity 0.8 or more."""
    out = near_duplicates(docs, shingle=5, percent=80).where("NOT kept").select("doc_id")
    return docs.select(*COLUMNS).join(out, "doc_id", "left_anti").select(*COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are blanked; widely copied examples stay."""
    clean = redacted(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by the weights that fit the flattened shares."""
    return mix(docs.select(*COLUMNS)).where("sampled").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, with_ids=False).drop("ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secret_scans", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: Tokens of a public vocabulary cannot be made in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
