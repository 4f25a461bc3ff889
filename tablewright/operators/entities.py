"""Whole-entity jobs: documents, reload policy and table tasks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.changes import (
    append_counted, current_version, delete_all, open_table, publish, publish_more, run_by_level, truncate,
)
from tablewright.operators.filters import typed_filter
from tablewright.operators.keys import collect_in_parts
from tablewright.operators.masking import mask_from
from tablewright.sources.tables import keep_rows, pick_settings


def assemble(
    root: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, str, Sequence[str]]], part_rows: int = 10_000
) -> DataFrame:
    """Nest child tables under their root row.

    ``children`` maps a field name to (table, key column, order columns). A
    root without children keeps empty arrays. A root with more than
    ``part_rows`` children in a field comes as several rows, told apart by
    ``part``, so that no row or task grows with a hot root.
    """
    collected = {}
    for name, (table, child_key, order) in children.items():
        values = [c for c in table.columns if c != child_key]
        docs = collect_in_parts(table, [child_key], order, values, name, part_rows)
        collected[name] = docs.withColumnRenamed(child_key, key)
    rows = root.withColumn("part", F.lit(0).cast("bigint"))
    further = None
    for docs in collected.values():
        later = docs.where(F.col("part") > 0).select(key, "part")
        further = later if further is None else further.unionByName(later)
    rows = rows.unionByName(root.join(further.distinct(), key).select(rows.columns))
    for name, docs in collected.items():
        kind = docs.schema[name].dataType
        rows = rows.join(docs, [key, "part"], "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return rows


def sync_outcomes(flags: DataFrame) -> DataFrame:
    """What happens to each entity: reload, keep or failed.

    ``flags`` has entity, sync, known (already in the target) and delete_only.
    An unknown entity that may not be read fails, unless it is only deleted.
    """
    failed = ~F.col("known") & ~F.col("delete_only")
    return flags.withColumn(
        "outcome", F.when(F.col("sync"), "reload").when(failed, "failed").otherwise("keep")
    )


def sync_rows(outcomes: DataFrame, source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The target after the run: reloaded rows from the source, all others as they were."""
    fresh = outcomes.where("outcome = 'reload'").select(F.col("entity").alias(key)).distinct()
    reloaded = source.join(fresh, key, "left_semi")
    kept = target.join(fresh, key, "left_anti")
    return reloaded.unionByName(kept)


def require_synced(outcomes: DataFrame) -> None:
    gone = outcomes.where("outcome = 'failed'").select("entity").take(5)
    if gone:
        names = ", ".join(str(r["entity"]) for r in gone)
        raise LookupError(f"entities not in the target while reading the source is off: {names}")


def mask_and_copy(
    df: DataFrame, columns: Sequence[str], where: str, masked: str, items: Sequence[str], rename: Mapping[str, str], path: str
) -> int:
    """Read with a filter, mask one column from a list, rename, and publish."""
    rows = df.where(where).select(*columns)
    rows = rows.withColumn(masked, mask_from(F.col(masked), masked, items))
    return publish(rows.withColumnsRenamed(dict(rename)), path)


@dataclass
class TableTask:
    """Which steps to run for a table, by name; the names come from the settings row."""

    extract: str = "typed"
    load: str = "publish"
    delete: bool | str = False
    where: str = ""
    params: list[tuple[str, str]] = field(default_factory=list)
    count: str = "count_where"


def _by_query(df: DataFrame, task: TableTask) -> DataFrame:
    return typed_filter(df, task.where, task.params)


def _by_scan(df: DataFrame, task: TableTask) -> DataFrame:
    """As by query; without marks the filter is plain text for the reader."""
    return keep_rows(df, task.where) if not task.params else typed_filter(df, task.where, task.params)


#: The steps that settings can name. A step that is not here is an error before anything runs.
EXTRACTS: dict[str, Callable[[DataFrame, TableTask], DataFrame]] = {
    "extract_by_query": _by_query, "extract_by_scan": _by_scan, "typed": _by_query, "whole": lambda df, task: df,
}
DELETES: dict[str, Callable[[SparkSession, str], int | None]] = {
    "delete_none": lambda spark, path: 0, "delete_all": delete_all, "truncate": truncate,
}
LOADS: dict[str, Callable[[DataFrame, str], int]] = {
    "load_atomic": publish_more, "publish": publish_more, "load_batched": append_counted, "load_replace": publish,
}
COUNTS: dict[str, Callable[[DataFrame], int]] = {"count_where": lambda rows: rows.count(), "count_none": lambda rows: -1}


def _step(known: Mapping[str, Callable], name: str, kind: str) -> Callable:
    if name not in known:
        raise ValueError(f"unknown {kind} step: {name}")
    return known[name]


def extract_rows(df: DataFrame, task: TableTask) -> DataFrame:
    """The rows a task asks for."""
    return _step(EXTRACTS, task.extract, "extract")(df, task)


def run_table_task(spark: SparkSession, df: DataFrame, task: TableTask, path: str) -> dict[str, int]:
    """Count, extract, optionally clear, and load one table; the counts come back.

    All four steps are looked up before the first of them runs.
    """
    extract, load = _step(EXTRACTS, task.extract, "extract"), _step(LOADS, task.load, "load")
    name = task.delete if isinstance(task.delete, str) else "delete_all" if task.delete else "delete_none"
    delete, count = _step(DELETES, name, "delete"), _step(COUNTS, task.count, "count")
    rows = extract(df, task)
    counted = count(rows)
    removed = delete(spark, path) if current_version(spark, path) is not None else 0
    loaded = load(rows, path)
    return {"counted": counted, "removed": removed, "loaded": loaded, "stored": open_loaded(spark, path).count()}


def open_loaded(spark: SparkSession, path: str) -> DataFrame:
    """What a load step has left, published or appended."""
    return open_table(spark, path) if current_version(spark, path) is not None else spark.read.parquet(path)


STEP_COLUMNS = {"extract_step": "extract", "delete_step": "delete", "load_step": "load", "count_step": "count"}


def tasks_from(
    spark: SparkSession, names: Sequence[str], settings: DataFrame, key: str = "table_name",
    filters: Mapping[str, tuple[str, Sequence[tuple[str, str]]]] | None = None,
) -> list[tuple[int, str, TableTask]]:
    """Level, table and task of each table, from its settings row or the default row (the one with an empty key).

    ``settings`` may have the columns ``extract_step``, ``delete_step``, ``load_step``, ``count_step`` and ``table_order``; what it does not
    have, or leaves null, is as ``TableTask`` says. ``filters`` gives a table's condition and the values of its marks.
    """
    items = spark.createDataFrame([(n,) for n in names], f"{key} string")
    out = []
    for row in pick_settings(items, settings, key).collect():  # one row per table of the run
        found = row.asDict()
        where, params = (filters or {}).get(found[key], ("", ()))
        steps = {own: found[c] for c, own in STEP_COLUMNS.items() if found.get(c) is not None}
        out.append((found.get("table_order") or 0, found[key], TableTask(where=where, params=list(params), **steps)))
    return sorted(out, key=lambda x: x[:2])


def run_tasks(
    spark: SparkSession, frames: Mapping[str, DataFrame], settings: DataFrame, root: str, key: str = "table_name",
    filters: Mapping[str, tuple[str, Sequence[tuple[str, str]]]] | None = None, parallel: int = 4,
) -> DataFrame:
    """Run each table's chain of steps as its settings say, level by level, parents first.

    Every step of every table is looked up before the first table runs. Status rows are those of ``run_by_level``; the count is
    that of the loaded rows.
    """
    tasks = tasks_from(spark, list(frames), settings, key, filters)
    for _, _, task in tasks:
        _step(EXTRACTS, task.extract, "extract"), _step(LOADS, task.load, "load"), _step(COUNTS, task.count, "count")
        _step(DELETES, task.delete if isinstance(task.delete, str) else "delete_all", "delete")
    levels: dict[int, dict[str, Callable[[], int]]] = {}
    for level, name, task in tasks:
        levels.setdefault(level, {})[name] = lambda n=name, t=task: run_table_task(spark, frames[n], t, f"{root}/{n}")["loaded"]
    return run_by_level(spark, list(levels.values()), parallel)
