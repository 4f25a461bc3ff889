"""Replacing personal values and re-keying rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.hashing import SEED, hash_hex, hash_number, hash_pick
from tablewright.functions.permuting import permuted
from tablewright.operators.changes import current_version, open_table
from tablewright.operators.generating import generate, numbered_value, room_for
from tablewright.operators.joins import replace_keys
from tablewright.operators.keys import dense_ids, match
from tablewright.operators.sequences import extend_sequence
from tablewright.operators.versions import VersionChanged, entries, show, stage
from tablewright.rules.generators import BY_CLASS


class DomainTooSmall(ValueError):
    """There are more distinct values than a unique generator can make."""


def mask_from(column: Column, label: str, items: Sequence[str]) -> Column:
    """One of ``items``, the same one for the same value; null stays null."""
    return F.when(column.isNotNull(), hash_pick(label, column, items))


def mask_from_table(df: DataFrame, column: str, label: str, items: DataFrame, numbered: str = "item_no") -> DataFrame:
    """As ``mask_from`` for long lists: ``items`` holds numbers 0 .. n-1 and values.

    Joins on the hashed number, so which list side is sent is Spark's choice by size.
    """
    size = items.count()
    value = [c for c in items.columns if c != numbered][0]
    pairs = items.select(F.col(numbered).alias("__no"), F.col(value).alias("__value"))
    drawn = F.when(F.col(column).isNotNull(), hash_number(label, F.col(column), 0) % F.lit(size))
    return df.withColumn("__no", drawn).join(pairs, "__no", "left").select(
        *[F.col("__value").alias(c) if c == column else F.col(c) for c in df.columns]
    )


def mask_email(first: Column, last: Column) -> Column:
    return F.lower(F.concat(first, F.lit("."), last, F.lit("@example.com")))


def unique_mapping(df: DataFrame, column: str, class_name: str, seed: str = SEED) -> DataFrame:
    """A different masked value for each distinct non-null value of a column, for this frame alone.

    Values are numbered in the order of their hash, so masks do not give away
    how the originals sort.
    """
    generator, settings, _, _ = BY_CLASS[class_name]
    values = df.select(F.col(column).alias("source_value")).where("source_value IS NOT NULL").distinct()
    mixed = values.withColumn("__h", hash_hex(class_name, F.col("source_value"), 0, seed))
    numbered = dense_ids(mixed, ["__h", "source_value"], "__n")
    value, room = numbered_value(generator, settings, F.col("__n"))
    if numbered.count() > room:
        raise DomainTooSmall(f"{class_name} has room for {room} values")
    return numbered.select("source_value", value.alias("target_value"))


def known_masks(spark: SparkSession, root: str, class_name: str) -> DataFrame:
    """The stored masks of a class: ``source_value`` as text, ``number`` and ``target_value`` as text."""
    path = f"{root}/{class_name}"
    if current_version(spark, path) is None:
        return spark.createDataFrame([], "source_value string, number bigint, target_value string")
    return open_table(spark, path)


def learn_masks(values: DataFrame, column: str, root: str, class_name: str, seed: str = SEED) -> DataFrame:
    """The stored masks of a class, after every value of a column has got one.

    A value that is known keeps its mask for ever, whichever table or run brought it; a new one gets the next number. The mask is
    the value that the class has at the number's place in a permutation keyed by class and seed, so masks differ as numbers do
    and neither they nor their order tell which values came first. Who knows the seed can undo them.

    Only new values are numbered and written. Two runs at once cannot give one number twice: the one that comes second starts over.
    """
    spark, path = values.sparkSession, f"{root}/{class_name}"
    generator, settings, _, _ = BY_CLASS[class_name]
    room = room_for(generator, settings)
    offered = values.select(F.col(column).cast("string").alias("source_value")).where("source_value IS NOT NULL").distinct()
    while True:
        version = current_version(spark, path)
        known = known_masks(spark, root, class_name)
        fresh = offered.join(known.select("source_value"), "source_value", "left_anti") if version else offered
        mixed = fresh.withColumn("__h", hash_hex(class_name, F.col("source_value"), 0, seed))
        last = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"] if version else 0
        numbered = dense_ids(mixed, ["__h", "source_value"], "number", start=last + 1)
        most = numbered.agg(F.max("number").alias("n")).first()["n"]
        if most is None:
            return known
        if most > room:
            raise DomainTooSmall(f"{class_name} has room for {room} values")
        place = permuted(F.col("number") - 1, room, class_name, seed) + F.lit(1)
        value, _ = numbered_value(generator, settings, F.col("place"))
        made = numbered.withColumn("place", place).select("source_value", "number", value.cast("string").alias("target_value"))
        folder, _ = stage(made, path)
        try:
            show(spark, path, [*entries(version), folder], version)
        except VersionChanged:
            continue
        return open_table(spark, path)


def _inside(column: Column, dtype: T.DataType, path: Sequence[str], row: Column, change: Callable) -> Column:
    """Apply ``change(value, type, row id)`` at a path through records and arrays."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(
            column, lambda v, i: _inside(v, dtype.elementType, path, F.concat_ws(".", row.cast("string"), i.cast("string")), change)
        )
    if not path:
        return change(column, dtype, row)
    inner = {f.name: f.dataType for f in dtype.fields}[path[0]]
    return F.when(
        column.isNotNull(), column.withField(path[0], _inside(column.getField(path[0]), inner, path[1:], row, change))
    )


def _leaves(column: Column, dtype: T.DataType, path: Sequence[str]) -> Column:
    """All values at a path as one array of texts."""
    if isinstance(dtype, T.ArrayType):
        parts = F.transform(column, lambda v: _leaves(v, dtype.elementType, path))
        return F.flatten(F.filter(parts, lambda p: p.isNotNull()))
    if not path:
        return F.array(column.cast("string"))
    inner = {f.name: f.dataType for f in dtype.fields}[path[0]]
    return _leaves(column.getField(path[0]), inner, path[1:])


def _with_masks(df: DataFrame, path: str, masks: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Swap the values at a path inside records and arrays for their masks.

    The values of a row are looked up one by one, wherever they lie, and come back to it as a map of its own values.
    """
    top, *rest = path.split(".")
    kind = df.schema[top].dataType
    values = df.select("__row_id", F.explode(_leaves(F.col(top), kind, rest)).alias("source_value"))
    values = values.where("source_value IS NOT NULL").distinct()
    pairs = values.join(masks(values, "source_value"), "source_value")
    by_row = pairs.groupBy("__row_id").agg(F.map_from_entries(F.collect_list(F.struct("source_value", "target_value"))).alias("__masks"))

    def change(value: Column, dtype: T.DataType, _: Column) -> Column:
        return F.when(value.isNotNull(), F.try_element_at(F.col("__masks"), value.cast("string")).cast(dtype))

    joined = match(df, by_row, ["__row_id"], "left")
    return joined.withColumn(top, _inside(F.col(top), kind, rest, F.col("__row_id"), change)).select(*df.columns)


def mask_by_class(
    df: DataFrame, classes: Mapping[str, str], row_id: str, dictionaries: str | None = None, seed: str = SEED,
) -> DataFrame:
    """Mask each classified column with its class's generator; all others pass through.

    Columns are named by path, so ``address.street`` or a field of an array of
    records can be masked in place. Consistent classes hash the value itself
    under the class name: the same value gets the same mask in every table.
    Other classes draw by row id. Null stays null.

    Unique classes look up a number for each distinct value. With ``dictionaries``, a shared folder, the numbers are stored per
    class: a value has one mask in all tables and runs, and no two values share one. Without it, masks hold for this frame only.
    ``seed`` is the secret that masks depend on; the default is public.
    """
    row, masked = F.col("__row_id"), df.withColumn("__row_id", F.col(row_id))
    # Unique masks first: they look up the values as they were.
    for path, class_name in classes.items():
        if class_name not in BY_CLASS or not BY_CLASS[class_name][3]:
            continue

        def masks(values: DataFrame, column: str, c: str = class_name) -> DataFrame:
            found = learn_masks(values, column, dictionaries, c, seed) if dictionaries else unique_mapping(values, column, c, seed)
            return found.select(*[F.col(x).cast("string").alias(x) for x in ("source_value", "target_value")])

        if "." in path or isinstance(df.schema[path].dataType, T.ArrayType):
            masked = _with_masks(masked, path, masks)
        else:
            swapped = replace_keys(masked.withColumn("__text", F.col(path).cast("string")), masks(df, path), "__text")
            masked = swapped.withColumn(path, F.col("__text").cast(df.schema[path].dataType)).drop("__text")
    changed: dict[str, Column] = {}
    for path, class_name in classes.items():
        if class_name not in BY_CLASS or BY_CLASS[class_name][3]:
            continue
        generator, settings, consistent, _ = BY_CLASS[class_name]

        def change(value, dtype, at, g=generator, s=settings, same=consistent, c=class_name, p=path):
            made = generate(g, s, c, value, seed) if same else generate(g, s, p, at, seed)
            return F.when(value.isNotNull(), made.cast(dtype))

        top, *rest = path.split(".")
        changed[top] = _inside(changed.get(top, F.col(top)), df.schema[top].dataType, rest, row, change)
    return masked.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])


def mask_with_policy(
    df: DataFrame, table: str, classes: Mapping[str, str], policy: DataFrame, row_id: str
) -> DataFrame:
    """Mask only the columns that the policy (table_name, column_name, enabled) switches on.

    Only this table's policy rows, at most one per column, are read up front.
    """
    rows = policy.where((F.col("table_name") == table) & F.col("enabled")).select("column_name").distinct().collect()
    on = {r["column_name"] for r in rows}
    return mask_by_class(df, {p: c for p, c in classes.items() if p in on}, row_id)


def key_mapping(frames: Sequence[tuple[DataFrame, str]], scope: Sequence[str] = (), start: int = 1, step: int = 1) -> DataFrame:
    """New keys for the old keys of several columns that share one sequence.

    Columns: the scope columns, ``source_value`` and ``target_value``. Old keys
    are merged before they are numbered, so hot keys cost nothing extra.
    """
    keys = None
    for df, column in frames:
        part = df.select(*scope, F.col(column).alias("source_value")).where("source_value IS NOT NULL").distinct()
        keys = part if keys is None else keys.unionByName(part)
    if len(frames) > 1:
        keys = keys.distinct()
    return dense_ids(keys, [*scope, "source_value"], "target_value", start, step)


def extend_mapping(
    spark: SparkSession, path: str, df: DataFrame, column: str, start: int = 1, step: int = 1, scope: Sequence[str] = (),
) -> DataFrame:
    """The stored mapping of a sequence with new old-keys added after its last number, in each scope."""
    return extend_sequence(spark, path, [(df, column)], scope, start, step)


def audit_rows(
    df: DataFrame, mapping: DataFrame, table: str, column: str, sequence: str, execution: str, unit: str
) -> DataFrame:
    """One row per replaced key: its scope, where it was, what it was and what it became."""
    scope = [c for c in mapping.columns if c not in ("source_value", "target_value")]
    old = df.select(*scope, F.col(column).alias("source_value")).where("source_value IS NOT NULL").distinct()
    return match(old, mapping, [*scope, "source_value"], "inner").select(
        *scope,
        F.lit(execution).alias("task_execution_id"), F.lit(unit).alias("lu_type"), F.lit(sequence).alias("seq_name"),
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.col("source_value").cast("string").alias("source_value"), F.col("target_value").cast("string").alias("target_value"),
    )
