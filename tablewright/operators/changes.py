"""Writing tables: appends, all-or-nothing publishing, deletes, upserts and their counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.casting import fit, fit_to_schema, lenient
from tablewright.operators.keys import match
from tablewright.operators.versions import (  # noqa: F401
    PublishError, bounds_of, current_version, drop_old_versions, entries, file_numbers, hits, open_table, open_version, publish, replace_files,
    show, stage, within,
)
from tablewright.sources import files

def publish_more(df: DataFrame, path: str) -> int:
    """Add rows to a table, all or none of them, without rewriting what is there."""
    return publish_more_together({path: df})[path]


def publish_more_together(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Add rows to several tables, and only when all of them could be staged.

    Rows are fitted to the published columns; a column a table lacks is an
    error. The swaps follow one by one, so each table on its own is all or nothing.
    """
    staged = {}
    for path, df in frames.items():
        spark = df.sparkSession
        version = current_version(spark, path)
        fitted = df if version is None else fit_to_schema(df, open_table(spark, path).schema)
        staged[path] = (version, *stage(fitted, path))
    for path, (version, folder, _) in staged.items():
        show(frames[path].sparkSession, path, [*entries(version), folder], version)
    return {path: rows for path, (_, _, rows) in staged.items()}


def append(df: DataFrame, path: str, batch_rows: int = 1_000_000) -> None:
    """Append rows so that every finished batch stays, whatever happens to later ones.

    Rows are fitted to the columns already stored; a column the table lacks is
    an error. A batch is one written file of at most ``batch_rows`` rows. The
    committer's direct mode makes each task's files visible when that task
    ends; there is no job-wide undo, so a failed run keeps what it had written.
    """
    spark = df.sparkSession
    if any(name.startswith("part-") for name in files.child_names(spark, path)):
        df = fit_to_schema(df, spark.read.parquet(path).schema)
    (
        df.write.mode("append")
        .option("maxRecordsPerFile", 1000 if batch_rows <= 0 else batch_rows)
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .parquet(path)
    )


def append_counted(df: DataFrame, path: str) -> int:
    """Append as ``append`` does; the number of rows sent comes back."""
    sent = Observation(uuid.uuid4().hex)
    append(df.observe(sent, F.count(F.lit(1)).alias("rows")), path)
    return sent.get["rows"]


def write_enforced(df: DataFrame, target: T.StructType, path: str) -> int:
    """Fit rows to the target's schema and publish them; surplus columns are an error."""
    return publish(fit_to_schema(df, target), path)


def delete_all(spark: SparkSession, path: str) -> int:
    """Publish an empty version with the same columns; the number of rows removed comes back."""
    version = current_version(spark, path)
    old = open_table(spark, path)
    removed = old.count()
    publish(spark.createDataFrame([], old.schema), path, expect=version)
    return removed


def truncate(spark: SparkSession, path: str) -> None:
    """Empty a table without reading its rows."""
    version = current_version(spark, path)
    publish(spark.createDataFrame([], open_table(spark, path).schema), path, expect=version)


def without_keys(target: DataFrame, keys_from: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key tuple is not among the given ones.

    Keys are made distinct first, so one hot key shuffles as one row per task,
    and the target is the left side, which the adaptive skew split can cut.
    """
    return target.join(keys_from.select(*keys).distinct(), list(keys), "left_anti")


def with_keys(target: DataFrame, keys_from: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(keys_from.select(*keys).distinct(), list(keys), "left_semi")


def delete_by_keys(spark: SparkSession, path: str, keys_from: DataFrame, keys: Sequence[str]) -> int:
    """Delete rows by key tuple; only the files that hold such rows are written anew. The number of rows removed comes back.

    Files whose footers lie outside the bounds of the keys are not even searched. A null in a key matches nothing.
    """
    version = current_version(spark, path)
    target = open_table(spark, path)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    bounds = _bounds(keys_from.where(whole), keys, target.schema)
    return _delete(spark, path, version, target, lambda df: with_keys(_near(df, bounds, keys), keys_from, keys),
                   lambda df: without_keys(df, keys_from, keys))


def replace_by_keys(spark: SparkSession, path: str, keys_from: DataFrame, keys: Sequence[str], rows: DataFrame) -> int:
    """Put ``rows`` in place of all rows that have one of the keys, at once; the number of rows removed comes back."""
    version = current_version(spark, path)
    target = open_table(spark, path)
    number, listed = file_numbers(spark, path, entries(version))
    hit = hits(with_keys(target.withColumn("__file", number), keys_from, keys), "__file", listed)
    fitted = fit_to_schema(rows, target.schema)
    if hit.files:
        fitted = without_keys(open_version(spark, path, hit.files, target.schema), keys_from, keys).unionByName(fitted)
    replace_files(spark, path, version, hit.files, fitted)
    return hit.rows


def _bounds(df: DataFrame, keys: Sequence[str], target: T.StructType) -> Row | None:
    """Bounds of the keys as the target stores them, or None where no key has bounds."""
    alike = [k for k in keys if df.schema[k].dataType == target[k].dataType]
    wanted = bounds_of(target, alike)
    return df.agg(*wanted).first() if wanted else None


def _near(df: DataFrame, bounds: Row | None, keys: Sequence[str]) -> DataFrame:
    return df if bounds is None else within(df, bounds, keys)


def _delete(
    spark: SparkSession, path: str, version: str, target: DataFrame,
    gone: Callable[[DataFrame], DataFrame], left: Callable[[DataFrame], DataFrame],
) -> int:
    number, listed = file_numbers(spark, path, entries(version))
    hit = hits(gone(target.withColumn("__file", number)), "__file", listed)
    if hit.files:
        replace_files(spark, path, version, hit.files, left(open_version(spark, path, hit.files, target.schema)))
    return hit.rows


def without_entity(target: DataFrame, column: str, value) -> DataFrame:
    """Rows of every other entity; a null id is not equal to any id, so it stays."""
    return target.where(~F.col(column).eqNullSafe(F.lit(value)))


def delete_by_entity(spark: SparkSession, path: str, column: str, value) -> int:
    """Delete an entity's rows; files whose footers rule the id out are not searched, and files without it stay as they are."""
    version = current_version(spark, path)
    target = open_table(spark, path)
    same = F.col(column).isNull() if value is None else F.col(column) == F.lit(value)
    return _delete(spark, path, version, target, lambda df: df.where(same), lambda df: without_entity(df, column, value))


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source, plus every source row."""
    fitted = fit_to_schema(source, target.schema)
    return match(target, fitted.select(*keys).distinct(), keys, "left_anti").unionByName(fitted)


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Replace on key match, else insert; two source rows with one key are an error.

    Only files that hold a matching row are written anew. Two null keys match.
    """
    version = current_version(spark, path)
    target = open_table(spark, path)
    fitted = fit_to_schema(source, target.schema)  # keys are compared as they will be stored
    per_key = fitted.groupBy(*keys).agg(F.count("*").alias("__n"))
    counted = F.coalesce(F.max("__n"), F.lit(0)).alias("__most"), F.coalesce(F.sum("__n"), F.lit(0)).alias("__offered")
    offer = per_key.agg(*counted, *bounds_of(target.schema, keys)).first()
    if offer["__most"] > 1:
        raise ValueError(f"source rows are not unique on {', '.join(keys)}")
    number, listed = file_numbers(spark, path, entries(version))
    near = within(target.select(*keys, number.alias("__file")), offer, keys)
    hit = hits(match(near, fitted.select(*keys), keys, "left_semi"), "__file", listed, keys)
    if hit.files:
        kept = match(open_version(spark, path, hit.files, target.schema), fitted.select(*keys), keys, "left_anti")
        replace_files(spark, path, version, hit.files, kept.unionByName(fitted))
    elif offer["__offered"]:
        replace_files(spark, path, version, (), fitted)
    return {"matched": hit.keys, "inserted": offer["__offered"] - hit.keys}


def change_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What an upsert of the source and a delete of its keys would touch, and -1 for a query.

    As in those: an upsert matches two null keys, a delete never does.
    """
    known = match(source, target.select(*keys).distinct(), keys, "left_semi").agg(F.count("*").alias("rows_affected"))
    new = match(source, target.select(*keys).distinct(), keys, "left_anti").agg(F.count("*").alias("rows_affected"))
    deleted = with_keys(target, source, keys).agg(F.count("*").alias("rows_affected"))
    label = lambda df, name: df.select(F.lit(name).alias("statement"), "rows_affected")
    query = deleted.select(F.lit("query").alias("statement"), F.lit(-1).cast("bigint").alias("rows_affected"))
    return label(known, "update").unionByName(label(new, "insert")).unionByName(label(deleted, "delete")).unionByName(query)


def split_errors(df: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the target, and one row per value that does not.

    The error rows hold the whole offending row as JSON beside column and raw
    value, so nothing is lost.
    """
    paired, failed = _judged(df, target)
    return _good(paired, failed, target), _bad(paired, failed, df.columns)


def _judged(df: DataFrame, target: T.StructType) -> tuple[DataFrame, dict[str, Column]]:
    """Raw and fitted columns side by side, and per raw column whether its value, or a value inside it, did not fit.

    Names match without regard to case; a column that the target does not know is an error.
    """
    fitted = fit_to_schema(df.limit(0), target, lenient)  # raises on surplus columns
    given = {f.name.lower(): f for f in df.schema.fields}
    fits, failed = [], {}
    for f in fitted.schema.fields:
        source, want = given.get(f.name.lower()), target[f.name].dataType
        if source is None:
            fits.append(F.lit(None).cast(want).alias(f"fit_{f.name}"))
            continue
        value = F.col(f"`{source.name}`")
        fits.append(fit(value, source.dataType, want, f.name, lenient).alias(f"fit_{f.name}"))
        failed[source.name] = _lost(F.col(f"`raw_{source.name}`"), source.dataType, want)
    return df.select(*[F.col(f"`{c}`").alias(f"raw_{c}") for c in df.columns], *fits), failed


def _lost(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether a value that is there becomes null, at any depth."""
    if isinstance(want, T.StructType):
        held = {f.name.lower(): f for f in have.fields}
        parts = [(held[f.name.lower()], f) for f in want.fields if f.name.lower() in held]
        inside = [_lost(column.getField(g.name), g.dataType, f.dataType) for g, f in parts]
        return F.coalesce(column.isNotNull() & reduce(lambda a, b: a | b, inside, F.lit(False)), F.lit(False))
    if isinstance(want, T.ArrayType):
        return F.coalesce(F.exists(column, lambda v: _lost(v, have.elementType, want.elementType)), F.lit(False))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        inside = lambda e: _lost(e["key"], have.keyType, want.keyType) | _lost(e["value"], have.valueType, want.valueType)
        return F.coalesce(F.exists(F.map_entries(column), inside), F.lit(False))
    if have == want or isinstance(have, (T.StructType, T.ArrayType)):
        return F.lit(False)
    return column.isNotNull() & lenient(column, want).isNull()


def _any(failed: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a | b, failed.values(), F.lit(False))


def _good(paired: DataFrame, failed: Mapping[str, Column], target: T.StructType) -> DataFrame:
    return paired.where(~_any(failed)).select(*[F.col(f"fit_{f.name}").alias(f.name) for f in target.fields])


def _bad(paired: DataFrame, failed: Mapping[str, Column], columns: Sequence[str]) -> DataFrame:
    whole = F.to_json(F.struct(*[F.col(f"raw_{c}").alias(c) for c in columns]))
    problems = F.filter(
        F.array(*[
            F.when(c, F.struct(F.lit(n).alias("column_name"), F.col(f"raw_{n}").cast("string").alias("raw_value")))
            for n, c in failed.items()
        ]),
        lambda p: p.isNotNull(),
    )
    bad = paired.where(_any(failed)).select(F.explode(problems).alias("p"), whole.alias("row_json"))
    return bad.select("p.column_name", "p.raw_value", "row_json")


def load_with_errors(df: DataFrame, target: T.StructType, good_path: str, error_path: str) -> tuple[int, int]:
    """Publish the rows that fit and, apart, the values that do not; both are staged before either shows.

    The first pass also counts the failing rows; the source is read again only
    if there are any.
    """
    spark = df.sparkSession
    versions = [current_version(spark, p) for p in (good_path, error_path)]
    paired, failed = _judged(df, target)
    seen = Observation(f"failing-{uuid.uuid4().hex}")
    watched = paired.observe(seen, F.count_if(_any(failed)).alias("rows"))
    loaded = stage(_good(watched, failed, target), good_path)
    bad = _bad(paired, failed, df.columns)
    wrong = stage(bad if seen.get["rows"] else spark.createDataFrame([], bad.schema), error_path)
    for path, (folder, _), version in zip((good_path, error_path), (loaded, wrong), versions):
        show(spark, path, [folder], version)
    return loaded[1], wrong[1]


def split_entities(df: DataFrame, target: T.StructType, entity: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split by whole entities: rows to load, error rows, and one outcome per entity.

    An entity with any value that does not fit has failed, and none of its rows
    are loaded. Failing entities are made distinct before they meet the rows.
    """
    paired, failed = _judged(df, target)
    raw = f"raw_{entity}"
    wrong = paired.where(_any(failed)).select(F.col(raw).alias("entity")).distinct()
    sound = paired.where(F.col(raw).isNotNull()).join(wrong, paired[raw] == wrong["entity"], "left_anti")
    loose = paired.where(F.col(raw).isNull() & ~_any(failed))
    good = _good(sound.unionByName(loose), failed, target)
    errors = _bad(paired, failed, df.columns).withColumn("entity", F.get_json_object("row_json", f"$.{entity}"))
    outcomes = (
        paired.where(F.col(raw).isNotNull()).groupBy(F.col(raw).alias("entity"))
        .agg(F.count("*").alias("row_count"), F.count_if(_any(failed)).alias("failed_rows"))
        .withColumn("outcome", F.when(F.col("failed_rows") > 0, "failed").otherwise("loaded"))
    )
    return good, errors, outcomes


def run_by_level(
    spark: SparkSession, levels: Sequence[Mapping[str, Callable[[], int]]], parallel: int = 4
) -> DataFrame:
    """Run the jobs of each level together, and the next level only if none failed.

    Each job is a Spark action that gives back its row count. The status rows
    (one per job) say ``done``, ``failed`` or ``skipped``.
    """
    status, stopped = [], False
    for number, jobs in enumerate(levels):
        if stopped:
            status += [(number, name, "skipped", None, None) for name in jobs]
            continue
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            running = {name: pool.submit(job) for name, job in jobs.items()}
        for name, job in running.items():
            error = job.exception()
            if error is None:
                status.append((number, name, "done", job.result(), None))
            else:
                stopped = True
                status.append((number, name, "failed", None, str(error) or type(error).__name__))
    return spark.createDataFrame(
        status, "level int, table_name string, status string, row_count bigint, message string"
    )


def load_by_level(
    spark: SparkSession, levels: Sequence[Mapping[str, DataFrame]], root: str, parallel: int = 4
) -> DataFrame:
    """Add rows to tables level by level, parents first."""
    jobs = [{n: (lambda df=df, n=n: publish_more(df, f"{root}/{n}")) for n, df in level.items()} for level in levels]
    return run_by_level(spark, jobs, parallel)


def delete_by_level(
    spark: SparkSession, levels: Sequence[Sequence[str]], root: str, parallel: int = 4
) -> DataFrame:
    """Empty tables level by level, children first; each count is the rows removed."""
    jobs = [{n: (lambda n=n: delete_all(spark, f"{root}/{n}")) for n in level} for level in levels]
    return run_by_level(spark, jobs, parallel)


def load_statistics(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows read and rows written per table."""
    sides = None
    for name, frames in pairs.items():
        for column, df in zip(("rows_read", "rows_written"), frames):
            counted = df.agg(F.count("*").alias("n")).select(
                F.lit(name).alias("table_name"),
                *[(F.col("n") if c == column else F.lit(0).cast("bigint")).alias(c) for c in ("rows_read", "rows_written")],
            )
            sides = counted if sides is None else sides.unionByName(counted)
    return sides.groupBy("table_name").agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_written").alias("rows_written"))
