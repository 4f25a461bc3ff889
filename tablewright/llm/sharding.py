"""Extendible hashing (native): a directory of hash prefixes whose oversized buckets alone split on another bit.

A bucket is a prefix of the 60-bit hash of a row's key. Starting from one bucket of depth 0, every bucket over the
byte limit gives way to its two halves, until all fit. Sizes are summed once into fine cells of some bits
more than an even spread needs; deeper cells are only made below cells that are still too large. So no
step reads the rows again, and no group is ever brought together: all sums have a map-side part.
A row finds its bucket by one join with the directory, which has an entry per address of that many bits.

Rows whose hashes agree in all bits (equal keys) cannot be split by bits. If they exceed the limit together, their
rows are numbered, and a second directory per such key splits them by the bits of the number, lowest first, in the
same way. No key is sorted or summed in one task. A single row above the limit is left out of this and has a part of its own.

Defined results: a null key hashes like the empty string and a null size counts as 0; equal rows go to one bucket
unless it is too large; an empty table gives an empty table; the input columns stay, whatever their names, and only
columns called like the four new ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import quoted, stored, unused

BITS = 60
NEW = ("shard", "shard_depth", "shard_part", "shard_bytes")


def key_hash(key: Column) -> Column:
    """The first 60 bits of md5, which any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def number_hash(number: Column) -> Column:
    """The lowest 60 bits of a number in reverse order: different numbers never agree, neighbours part at the first bit."""
    return F.conv(F.substring(F.reverse(F.lpad(F.bin(number), 64, "0")), 1, BITS), 2, 10).cast("long")


def _right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits.cast("int"))


def _left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits.cast("int"))


def _prefix(bits: Column, depth: Column) -> Column:
    return _right(bits, F.lit(BITS) - depth)


def _bits(prefix: Column, depth: Column) -> Column:
    """The prefix as ``depth`` figures 0 and 1."""
    return F.when(depth == 0, "").otherwise(F.lpad(F.bin(prefix), depth.cast("int"), F.lit("0")))


def base_bits(total: Column, limit: int, step: int) -> Column:
    """Bits of the addresses for ``total`` bytes: ``step`` more than an even spread needs."""
    return F.least(F.lit(BITS), F.ceil(F.log2(F.greatest(total / limit, F.lit(1.0)))) + F.lit(max(step, 1))).cast("int")


def leaves(sizes: DataFrame, limit: int, step: int) -> DataFrame:
    """(owner, depth, prefix, bytes) of the final buckets of (owner, h, bytes), each owner with buckets of its own."""
    total = sizes.groupBy("owner").agg(F.sum("bytes").alias("bytes")).agg(F.max("bytes")).first()[0] or 0
    depth = min(BITS, math.ceil(math.log2(max(total / limit, 1))) + max(step, 1))
    open_, low, done = sizes, 0, []
    while True:
        cells = stored(open_.groupBy("owner", _prefix(F.col("h"), F.lit(depth)).alias("cell")).agg(F.sum("bytes").alias("bytes")), "cells")
        at = cells.select("owner", "bytes", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth"), "cell")
        at = at.select("owner", "depth", _right(F.col("cell"), F.lit(depth) - F.col("depth")).alias("prefix"), "bytes")
        nodes = stored(at.groupBy("owner", "depth", "prefix").agg(F.sum("bytes").alias("bytes")), "nodes")
        parent = nodes.where(F.col("bytes") > limit).select(
            "owner", (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
        fits = (F.col("bytes") <= limit) | (F.col("depth") == BITS)
        top = nodes.where((F.col("depth") == low) & fits) if low == 0 else nodes.limit(0)
        done.append(top.union(nodes.where(fits).join(parent, ["owner", "depth", "prefix"], "left_semi").select(nodes.columns)))
        over = nodes.where((F.col("depth") == depth) & (F.col("bytes") > limit)).select("owner", F.col("prefix").alias("cell"))
        if depth == BITS or over.isEmpty():
            break
        open_ = stored(open_.withColumn("cell", _prefix(F.col("h"), F.lit(depth))).join(
            over, ["owner", "cell"], "left_semi").select("owner", "h", "bytes"), "open")
        # deeper cells are only made below cells that are too large: few, and never more than there are different hashes
        low, depth, step = depth, min(BITS, depth + 2 * step), 2 * step
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return stored(out.dropDuplicates(["owner", "depth", "prefix"]), "leaves")


def directory(leaf: DataFrame) -> DataFrame:
    """(owner, address, buckets) from leaves with columns ``base`` and ``second``: per address of ``base`` bits its bucket, or the buckets below it.

    A bucket of fewer bits has an entry for each address; they are made in two steps, so that no row holds a long list.
    """
    up, down = (F.greatest(x, F.lit(0)) for x in (F.col("base") - F.col("depth"), F.col("depth") - F.col("base")))
    low = F.floor(F.col("up") / 2)

    def numbers(bits: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), _left(F.lit(1).cast("long"), bits) - 1))

    at = leaf.select(
        "owner", F.struct("depth", "prefix", "bytes", "second").alias("bucket"), up.alias("up"), _left(_right(F.col("prefix"), down), up).alias("first"))
    at = at.select("*", numbers(F.col("up") - low).alias("high")).select("*", numbers(low).alias("low"))
    return at.select("owner", (F.col("first") + _left(F.col("high"), low) + F.col("low")).alias("address"), "bucket").groupBy(
        "owner", "address").agg(F.collect_list("bucket").alias("buckets"))


def shard(
    docs: DataFrame, key: str = "doc_id", size: Column | None = None, *, limit: int = 64 << 20, step: int = 4,
) -> DataFrame:
    """The rows with ``shard`` (prefix bits and part), ``shard_depth``, ``shard_part`` and ``shard_bytes``.

    ``shard_part`` is 0 for a bucket that fits. In one that does not, it is the prefix of the second directory with a
    one before it, or, for a single row above the limit, the number of the row as a negative number.
    """
    h, n, address, found, number, order, base_, shard_ = (
        unused(docs, f"__{x}") for x in ("h", "bytes", "address", "found", "number", "order", "base", "shard"))
    size = F.coalesce(F.length(F.col("text").cast("binary")) if size is None else size, F.lit(0)).cast("long")
    sized = docs.withColumn(h, key_hash(F.col(key))).withColumn(n, size).drop(*NEW)
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in NEW]
    leaf = leaves(sized.select(F.lit(0).cast("long").alias("owner"), F.col(h).alias("h"), F.col(n).alias("bytes")), limit, step)
    total = leaf.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("t")).select(base_bits(F.col("t"), limit, step)).first()[0]
    # buckets over the limit get a second directory; the length of its addresses is stored, so that both sides read the same one
    leaf = stored(leaf.withColumn("second", base_bits(F.col("bytes"), limit, step)), "buckets")

    def placed(rows: DataFrame, hashed: str, base: Column, entry: DataFrame, on: list[str]) -> DataFrame:
        """Rows with their bucket; the rows are the side that may hold a hot key, entries are unique."""
        entry = entry.withColumnsRenamed({"owner": h, "address": address, "buckets": found}).select(*on, found)
        at = rows.withColumn(address, _prefix(F.col(hashed), base)).join(entry, on)
        return at.withColumn(found, F.get(F.filter(found, lambda b: _prefix(F.col(hashed), b["depth"]) == b["prefix"]), F.lit(0)))

    out = placed(sized, h, F.lit(total), directory(leaf.withColumn("base", F.lit(total))), [address])
    bucket = F.col(found)
    bits = _bits(bucket["prefix"], bucket["depth"])
    whole = out.where(bucket["bytes"] <= limit).select(
        *kept, bucket["depth"].alias("shard_depth"), F.lit(0).cast("long").alias("shard_part"), bucket["bytes"].alias("shard_bytes"), bits.alias("shard"))
    over = leaf.where(F.col("bytes") > limit)
    if over.isEmpty():
        return whole
    # only keys that are over the limit by themselves are left; the numbers of their rows are written before use
    rows = stored(out.where(bucket["bytes"] > limit).drop(address).withColumn(number, F.monotonically_increasing_id()).withColumn(
        order, number_hash(F.col(number))).withColumn(base_, bucket["second"]).withColumn(shard_, bits).drop(found), "numbered")
    alone = rows.where(F.col(n) > limit).select(
        *kept, F.lit(BITS).alias("shard_depth"), (-1 - F.col(number)).alias("shard_part"), F.col(n).alias("shard_bytes"),
        F.concat(F.col(shard_), F.lit(".row"), F.col(number)).alias("shard"))
    rest = rows.where(F.col(n) <= limit)
    small = leaves(rest.select(F.col(h).alias("owner"), F.col(order).alias("h"), F.col(n).alias("bytes")), limit, step)
    bases = over.select(F.col("prefix").alias("owner"), F.col("second").alias("base"))
    entry = directory(small.withColumn("second", F.lit(0)).join(bases, "owner"))
    part = placed(rest, order, F.col(base_), entry, [h, address]).select(
        *kept, F.lit(BITS).alias("shard_depth"), (_left(F.lit(1).cast("long"), bucket["depth"]) + bucket["prefix"]).alias("shard_part"),
        bucket["bytes"].alias("shard_bytes"), F.concat(F.col(shard_), F.lit("."), _bits(bucket["prefix"], bucket["depth"])).alias("shard"))
    return whole.unionByName(part).unionByName(alone)
