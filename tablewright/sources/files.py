"""Small-file work on the shared folder through the cluster's own file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _locate(spark, path)
    return fs.exists(place)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, place = _locate(spark, path)
    return fs.exists(place) and fs.getFileStatus(place).isDirectory()


def inner_path(spark: SparkSession, path: str) -> str:
    """The path without scheme and host."""
    fs, place = _locate(spark, path)
    return fs.makeQualified(place).toUri().getPath()


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _locate(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files below a folder at any depth, by their place in it, with their bytes; a file is its own, nameless one."""
    fs, place = _locate(spark, path)
    root, found, walk = fs.makeQualified(place).toString(), [], fs.listFiles(place, True)
    while walk.hasNext():
        status = walk.next()
        name = status.getPath().toString()[len(root):].lstrip("/")
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append((name, status.getLen()))
    return sorted(found)


def move(spark: SparkSession, path: str, place: str) -> None:
    """Rename a file; an error if there is one of that name."""
    fs, source = _locate(spark, path)
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(place)):
        raise OSError(f"{path} could not be moved to {place}")


def state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of what lies directly in a folder."""
    fs, place = _locate(spark, path)
    found = fs.listStatus(place) if fs.exists(place) else []
    return ",".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in found))


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, place = _locate(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _locate(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def try_read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, or None if there is none or another writer is just replacing it."""
    try:
        return read_text(spark, path) if exists(spark, path) else None
    except Py4JJavaError as e:
        if not any(name in str(e.java_exception) for name in ("FileNotFound", "ChecksumException")):
            raise
        return None


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` beside ``path`` and swap it in with one rename."""
    fs, place = _locate(spark, path)
    fs.mkdirs(place.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        place.toUri() if place.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(draft, place, options)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with ``text`` unless there is one; false if there is. The rename never replaces a file."""
    fs, place = _locate(spark, path)
    if fs.exists(place):
        return False
    draft = f"{path}.{uuid.uuid4().hex}"
    replace_text(spark, draft, text)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        place.toUri() if place.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    none = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), place, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        delete_tree(spark, draft)
        return False
    return True
