"""Structured Streaming forms of the two write modes."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.casting import fit_to_schema
from tablewright.operators.versions import current_version, entries, open_table, show_more, write_checked
from tablewright.sources import files


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a table as a stream, whether it is a folder or a single file."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if files.is_folder(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def _run_name(spark: SparkSession, checkpoint: str, name: str | None) -> str:
    """The name under which a checkpoint's batches are kept; a rerun on the same checkpoint goes on under it."""
    marker = f"{checkpoint}/run"
    if name is not None and not re.fullmatch("[A-Za-z0-9]+", name):
        raise ValueError("a run is named by letters and figures")
    if not files.exists(spark, marker):
        files.create_text(spark, marker, name or uuid.uuid4().hex)
    found = files.read_text(spark, marker).strip()
    if name is not None and found != name:
        raise ValueError(f"the checkpoint belongs to run {found}")
    return found


def append_stream(stream: DataFrame, target: str, checkpoint: str, run: str | None = None) -> int:
    """Append all that is new, batch by batch; each batch stands once it is committed. The number of added rows comes back.

    Batches live beside rows that were written otherwise: in a published table a batch is a folder that the next version lists, in a
    plain folder of files its files are moved in among the others. Rows are fitted to the stored columns; a column that the
    table lacks is an error before anything is read.

    A batch is staged under the names of its run and its number, and as many rows must be stored as were sent. Spark repeats a batch
    whose end it did not see: one that is staged whole is not written again but only shown, so its rows never count twice.
    The checkpoint makes a rerun add only unseen rows; task retries are Spark's.
    """
    spark = stream.sparkSession
    published = current_version(spark, target) is not None
    known = None
    if published:
        known = open_table(spark, target).schema
    elif any(name.startswith("part-") for name in files.child_names(spark, target)):
        known = spark.read.parquet(target).schema
    if known is not None:
        fit_to_schema(stream, known)
    run, added = _run_name(spark, checkpoint, run), {}

    def keep(batch: DataFrame, batch_id: int) -> None:
        fitted = batch if known is None else fit_to_schema(batch, known)
        if published:
            folder = f"{_folder(run)}/b-{batch_id:09d}"
            staged, done = f"{target}/{folder}", f"{target}/{_folder(run)}/_b-{batch_id:09d}"
        else:
            staged, done = f"{target}/_staged/{run}/b-{batch_id:09d}", f"{target}/_staged/{run}/_b-{batch_id:09d}"
        if not files.exists(spark, done):
            files.create_text(spark, done, str(write_checked(fitted, staged)))
        if published:
            show_more(spark, target, folder)
        else:
            for i, (name, _) in enumerate(files.below(spark, staged)):
                files.move(spark, f"{staged}/{name}", f"{target}/part-s{run}-b{batch_id:09d}-{name}")
        added[batch_id] = int(files.read_text(spark, done))

    query = (
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{checkpoint}/query")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(added.values())


def _folder(run: str) -> str:
    """The table folder of a run; of the same shape as all others."""
    return f"v-{hashlib.md5(run.encode()).hexdigest()}"


def publish_stream(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Stage every batch and add the whole run to the table at the end, or nothing if a batch fails.

    A batch is staged under its id and replaced when Spark replays it, so a
    rerun cannot double rows. Rows are fitted to the published columns; a column
    the table lacks is an error before anything is read, and the stored rows of a
    batch must be as many as were sent. A rerun after a failure goes on in the same
    staging folder, which the checkpoint remembers until it is published. The
    number of added rows comes back.
    """
    spark = stream.sparkSession
    known = open_table(spark, path).schema if current_version(spark, path) else None
    if known is not None:
        fit_to_schema(stream, known)
    marker = f"{checkpoint}/staging"
    folder = files.read_text(spark, marker).strip() if files.exists(spark, marker) else None
    if folder is None or folder in entries(current_version(spark, path)):
        folder = f"v-{uuid.uuid4().hex}"
        files.replace_text(spark, marker, folder)

    def keep(batch: DataFrame, batch_id: int) -> None:
        write_checked(batch if known is None else fit_to_schema(batch, known), f"{path}/{folder}/b-{batch_id:09d}")

    query = (
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{checkpoint}/query")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not files.exists(spark, f"{path}/{folder}"):
        return 0
    show_more(spark, path, folder)
    files.delete_tree(spark, marker)
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/{folder}").count()


def batch_counts(spark: SparkSession, path: str, runs: Sequence[str] = ()) -> DataFrame:
    """Rows per streamed batch, a row for each batch of each run, of a published table or a plain folder.

    With the names of runs, the result also has ``run``: the name, or null for a run that is not among them.
    """
    plain = current_version(spark, path) is None
    rows = spark.read.parquet(path) if plain else open_table(spark, path)
    pattern = r"/part-s([A-Za-z0-9]+)-b(\d{9})-[^/]*$" if plain else r"/(v-[0-9a-f]{32})/b-(\d+)/[^/]*$"
    part = lambda n: F.regexp_extract(F.col("_metadata.file_path"), pattern, n)
    found = rows.select(part(1).alias("__run"), part(2).alias("batch")).where("batch <> ''")
    counted = found.groupBy("__run", F.col("batch").cast("bigint").alias("batch_id")).agg(F.count("*").alias("rows_written"))
    if not runs:
        return counted.drop("__run")
    known = spark.createDataFrame([(name if plain else _folder(name), name) for name in runs], "__run string, run string")
    return counted.join(known, "__run", "left").select("run", "batch_id", "rows_written")
