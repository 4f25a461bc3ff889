"""Published tables: which folders and files make up a version, and how the next one follows it.

A version is a text of entries, one per line. An entry is a folder, or a file where the folder has lost some of its files: a
change replaces the files that hold changed rows and names all others as they were. Readers, writers and Spark's own listing
see the same entries; the text grows with the files of changed folders until ``compact`` joins them again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources import files

POINTER = "_CURRENT"
#: The entry in a file's path.
ENTRY = r"^.*/(v-[0-9a-f]{32}/.*)$"
#: Types whose bounds mean the same to Spark, to the file footers and to the driver.
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.DateType)


class PublishError(RuntimeError):
    """The staged rows do not match what was sent; the target is unchanged."""


class VersionChanged(PublishError):
    """Another writer has published since the rows were made."""


def current_version(spark: SparkSession, path: str) -> str | None:
    """Entries that make up the published table, one per line.

    The pointer is a shortcut, and may be old or, while it is replaced, not there: each version names its successor in a file
    that only one writer can make and nobody replaces, from the first one on.
    """
    version = (files.try_read_text(spark, f"{path}/{POINTER}") or "").strip() or None
    while files.exists(spark, _successor(path, version)):
        version = files.read_text(spark, _successor(path, version)).strip()
    return version


def _successor(path: str, version: str | None) -> str:
    return f"{path}/_NEXT_{hashlib.md5((version or '').encode()).hexdigest()}"


def entries(version: str | None) -> list[str]:
    """Folders and files of a version; a line that only makes its text another one is none."""
    return [name for name in version.split("\n") if not name.startswith("#")] if version else []


def _next_text(spark: SparkSession, path: str, version: str | None, names: Sequence[str]) -> str:
    """The text of a version that follows; no text comes twice, so that the way from version to version never leads back."""
    text = "\n".join(names)
    if text == version or files.exists(spark, _successor(path, text)):
        text += f"\n#{uuid.uuid4().hex}"
    return text


def open_version(spark: SparkSession, path: str, names: Collection[str], schema: T.StructType | None = None) -> DataFrame:
    """The rows of some entries."""
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema else reader
    return reader.parquet(*[f"{path}/{name}" for name in names])


def open_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The published rows of a table; readers never see staged ones."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing published at {path}")
    return open_version(spark, path, entries(version), schema)


def stage(df: DataFrame, path: str) -> tuple[str, int]:
    """Write rows as a version that nobody sees yet; its name and checked row count come back."""
    folder = f"v-{uuid.uuid4().hex}"
    return folder, write_checked(df, f"{path}/{folder}")


def write_checked(df: DataFrame, place: str) -> int:
    """Write a folder anew; as many rows must be stored as were sent."""
    spark, sent = df.sparkSession, Observation(uuid.uuid4().hex)
    df.observe(sent, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(place)
    rows = sent.get["rows"]
    stored = spark.read.schema(df.schema).parquet(place).count()
    if stored != rows:
        raise PublishError(f"{rows} rows were sent to {place} but {stored} were stored")
    return stored


def show(spark: SparkSession, path: str, names: Sequence[str], expect=...) -> None:
    """Make staged entries the published table, by one rename that never replaces a file.

    ``expect`` names the version the rows were made from; if another writer
    has published since, nothing is swapped. Of two writers that follow one
    version only one can make its successor.
    """
    while True:
        version = current_version(spark, path)
        if expect is not ... and version != expect:
            raise VersionChanged(f"{path} was changed by another writer")
        text = _next_text(spark, path, version, names)
        if files.create_text(spark, _successor(path, version), text):
            break
    files.replace_text(spark, f"{path}/{POINTER}", text)


def show_more(spark: SparkSession, path: str, folder: str) -> bool:
    """Add a staged folder to whatever is published; false if it is there already. Writers that add never stand in each other's way."""
    while True:
        version = current_version(spark, path)
        if folder in entries(version):
            return False
        text = _next_text(spark, path, version, [*entries(version), folder])
        if files.create_text(spark, _successor(path, version), text):
            files.replace_text(spark, f"{path}/{POINTER}", text)
            return True


def publish(df: DataFrame, path: str, expect=...) -> int:
    """Replace a table: write a new version, check its row count and swap it in.

    A failure at any point leaves the published version as it was.
    """
    folder, rows = stage(df, path)
    show(df.sparkSession, path, [folder], expect)
    return rows


def file_name() -> Column:
    """The entry of the file a row was read from; the frame must come straight from ``open_table`` or ``open_version``."""
    return F.regexp_extract(F.col("_metadata.file_path"), ENTRY, 1)


def file_numbers(spark: SparkSession, path: str, names: Collection[str]) -> tuple[Column, dict]:
    """A column that tells the file a row was read from in eight bytes, and the files of these entries by it.

    A path takes hundreds of bytes in each row that is shuffled and sorted. Where two files have one name or one
    number, the entry itself tells them apart.
    """
    listed = []
    for name in names:
        listed += [f"{name}/{inner}" if inner else name for inner, _ in files.below(spark, f"{path}/{name}")]
    rows = spark.range(0, 1, 1, 1).select(F.explode(F.split(F.lit("\n".join(listed)), "\n")).alias("entry"))
    found = {r["number"]: r["entry"] for r in rows.select("entry", F.xxhash64(F.substring_index("entry", "/", -1)).alias("number")).collect()}
    if len(found) == len(listed):
        return F.xxhash64("_metadata.file_name"), found
    return file_name(), {n: n for n in listed}


@dataclass(frozen=True)
class Hits:
    """What a change touches: the files, their matching rows, and how many distinct keys those have."""

    files: tuple[str, ...]
    rows: int
    keys: int


def hits(matching: DataFrame, file: str, listed: Mapping, keys: Sequence[str] = ()) -> Hits:
    """Files that hold matching rows; ``file`` is the column of ``file_numbers``. They are as many as the driver lists to read the table."""
    counted = [F.count_distinct(F.struct(*keys)).alias("keys")] if keys else [F.lit(0).alias("keys")]
    row = matching.agg(F.collect_set(file).alias("files"), F.count("*").alias("rows"), *counted).first()
    return Hits(tuple(sorted(listed[f] for f in row["files"])), row["rows"], row["keys"])


def bounds_of(schema: T.StructType, keys: Sequence[str]) -> list[Column]:
    """Aggregates for ``within``: least, greatest and whether any is null, for each key whose order the footers know."""
    out = []
    for k in keys:
        if isinstance(schema[k].dataType, BOUNDED):
            out += [F.min(k).alias(f"low_{k}"), F.max(k).alias(f"high_{k}"), F.count_if(F.col(k).isNull()).alias(f"nulls_{k}")]
    return out


def within(df: DataFrame, bounds, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys lie between the bounds; the comparison reaches the file footers, so other files and row groups are not read.

    A key is null only where the bounds have seen a null.
    """
    for k in keys:
        if f"low_{k}" in bounds:
            low, high = bounds[f"low_{k}"], bounds[f"high_{k}"]
            near = F.lit(False) if low is None else F.col(k).between(F.lit(low), F.lit(high))
            df = df.where(near | F.col(k).isNull() if bounds[f"nulls_{k}"] else near)
    return df


def without_files(spark: SparkSession, path: str, version: str, gone: Collection[str]) -> list[str]:
    """Entries of a version less some files; a folder that loses one is named file by file."""
    gone = set(gone)
    opened = {name[:i] for name in gone for i, c in enumerate(name) if c == "/"}
    out = []
    for entry in entries(version):
        if entry in opened:
            out += [f"{entry}/{name}" for name, _ in files.below(spark, f"{path}/{entry}") if f"{entry}/{name}" not in gone]
        elif entry not in gone:
            out.append(entry)
    return out


def replace_files(spark: SparkSession, path: str, version: str, gone: Collection[str], rows: DataFrame) -> int:
    """Publish ``rows`` in place of some files; all other files keep their names. Without rows nothing comes in their place."""
    folder, stored = stage(rows, path)
    kept = without_files(spark, path, version, gone)
    show(spark, path, [*kept, folder] if stored or not kept else kept, version)
    return stored


def compact(spark: SparkSession, path: str, small_bytes: int = 64 << 20, file_bytes: int = 256 << 20) -> int:
    """Join files below ``small_bytes`` into files of about ``file_bytes``; the number of joined files comes back.

    Larger files keep their names. Rows stay what they are, but no longer tell which streamed batch brought them.
    """
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing published at {path}")
    listed = []
    for entry in entries(version):
        found = files.below(spark, f"{path}/{entry}")
        listed += [(f"{entry}/{name}" if name else entry, size) for name, size in found]
    small = [(name, size) for name, size in listed if size < small_bytes]
    pieces = max(1, -(-sum(size for _, size in small) // file_bytes))
    if len(small) <= pieces:
        return 0
    schema = open_table(spark, path).schema
    joined = open_version(spark, path, [name for name, _ in small], schema).coalesce(pieces)
    replace_files(spark, path, version, [name for name, _ in small], joined)
    return len(small)


def drop_old_versions(spark: SparkSession, path: str) -> list[str]:
    """Delete folders and files that are not part of the published table; run it when nobody is writing."""
    current = set(entries(current_version(spark, path)))
    opened = {name.split("/")[0] for name in current if "/" in name}
    old = []
    for name in files.child_names(spark, path):
        if not name.startswith("v-") or name in current:
            continue
        if name in opened:
            inside = [f"{name}/{x}" for x, _ in files.below(spark, f"{path}/{name}")]
            old += [x for x in inside if x not in current]
        else:
            old.append(name)
    for name in old:
        files.delete_tree(spark, f"{path}/{name}")
    return old
