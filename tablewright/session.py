"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Joins here keep the side that can hold a hot key on the left, so the
# adaptive skew split applies to inner, left, semi and anti joins alike.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive settings that the operators count on."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablewright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in {**ADAPTIVE, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting: on a cluster a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tablewright-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; frames made from it stop working."""
    from tablewright.sources.files import delete_tree

    delete_tree(spark, f"{shared_root(spark)}/tablewright/{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tablewright/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
