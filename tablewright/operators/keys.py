"""Sequence ids, batches, positions and last-wins; no task ever gets a whole table or a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import scratch_path


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys where two nulls count as equal; the right keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    condition = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"__r_{k}"])
        condition = same if condition is None else condition & same
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def dense_ids(df: DataFrame, order: Sequence[str], name: str = "seq_id", start: int = 1, step: int = 1) -> DataFrame:
    """Number the rows start, start+step, ... in ``order``, which must be unique.

    One range shuffle sorts the rows into chunks, and the sorted chunks are
    written to the shared folder with their chunk number and place. The sizes
    of the chunks (one row per written task, so bounded by the partition count)
    then give each chunk its offset. Writing first pins the chunk contents:
    a lost executor can no longer change which row got which place.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ids")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    placed = spark.read.parquet(path).withColumn("__chunk", F.shiftright("__place", 33))
    before, offsets = 0, []
    for row in sorted(placed.groupBy("__chunk").count().collect()):
        offsets.append((row["__chunk"], before))
        before += row["count"]
    chunks = spark.createDataFrame(offsets, "__chunk bigint, __before bigint")
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(chunks), "__chunk")
        .withColumn(name, F.lit(start) + (F.col("__before") + within) * F.lit(step))
        .select(*df.columns, name)
    )


def batch_numbers(df: DataFrame, order: Sequence[str], size: int = 1000, name: str = "batch_no") -> DataFrame:
    """The zero-based batch each row falls in; a size of zero or less means 1000."""
    rows = 1000 if size <= 0 else size
    numbered = dense_ids(df, order, "__id")
    return numbered.withColumn(name, F.floor((F.col("__id") - 1) / F.lit(rows)).cast("bigint")).drop("__id")


def large_keys(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame | None:
    """Keys with more than ``rows`` rows, or None if there are none; counts merge before the shuffle."""
    found = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > rows).select(*keys)
    return None if found.isEmpty() else found


def _numbered_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Places as the global number minus the key's first number: no key is sorted by one task."""
    numbered = dense_ids(df, [*keys, *order], "__id")
    firsts = numbered.groupBy(*keys).agg(F.min("__id").alias("__first"))
    return (
        match(numbered, firsts, keys, "inner")
        .withColumn(name, F.col("__id") - F.col("__first"))
        .select(*df.columns, name)
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position", window_rows: int = 1_000_000
) -> DataFrame:
    """Zero-based place of each row within its key, in ``order``, which must be unique in the key.

    Keys of up to ``window_rows`` rows are numbered by an ordinary window, one
    shuffle. Larger keys go through the global numbering instead.
    """
    place = (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint")
    large = large_keys(df, keys, window_rows)
    if large is None:
        return df.withColumn(name, place)
    small = match(df, large, keys, "left_anti").withColumn(name, place)
    return small.unionByName(_numbered_positions(match(df, large, keys, "left_semi"), keys, order, name))


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; an aggregate, so duplicates merge before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    last = F.max(F.struct(*order, *rest)).alias("__last")
    return df.groupBy(*keys).agg(last).select(
        *[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in df.columns]
    )


def collect_in_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    name: str = "items", part_rows: int = 10_000,
) -> DataFrame:
    """Gather each key's rows, in order, into arrays of at most ``part_rows`` records.

    A key's rows are cut into consecutive parts by their place in the key, counted from 0. Keys that fill one part at most are
    gathered by one shuffle. Only the rows of larger keys are numbered first, so that their parts go to different tasks; no task
    ever holds a whole hot key and nothing is left out. Whoever joins on the result must carry ``part``.
    """
    ordered = F.sort_array(F.collect_list(F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                                                   F.struct(*values).alias("v"))))
    items = F.transform(ordered, lambda r: r["v"]).alias(name)
    part = F.lit(0).cast("bigint").alias("part")
    large = large_keys(df, keys, part_rows)
    if large is None:
        return df.groupBy(*keys).agg(items).select(*keys, part, name)
    small = match(df, large, keys, "left_anti").groupBy(*keys).agg(items).select(*keys, part, name)
    placed = _numbered_positions(match(df, large, keys, "left_semi"), keys, order, "__position")
    cut = placed.withColumn("part", F.floor(F.col("__position") / F.lit(part_rows)).cast("bigint"))
    return small.unionByName(cut.groupBy(*keys, "part").agg(items))
