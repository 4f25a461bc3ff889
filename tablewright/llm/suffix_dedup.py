"""Removes every byte covered by a string of ``length`` bytes that also starts elsewhere in the corpus.

Candidates. A window is a string of ``length`` bytes. Its mark is the least hash of the short strings in
it, so equal windows have equal marks. Runs of windows with one mark are cut from the text with the bytes
that the last window needs (a context). Only marks that occur at two places of different texts or of
one text go on: a task sends one row of a mark that it sees again to the sum over all tasks, its other rows need none.
Equal texts are cut once, equal contexts are one string with the number of places they stand for. Texts travel compressed.

Equal windows also agree in the mark's short string together with half of the other bytes, before or after it;
contexts that stand for one place and agree with no other in either are left out.

Shards. All contexts of a mark go to one shard. A shard concatenates whole marks up to ``shard_bytes``, sorts the
suffixes by induced sorting (LMS suffixes by doubling, the rest by linear induction) and computes the
permuted common prefixes. A window repeats if its suffix shares ``length`` bytes with a neighbour in the suffix array
or stands for more than one place. Matches end at the ends of contexts, so they never cross documents.

Contexts of one mark beyond ``mark_bytes`` would be too much for a task. They are dealt again by the bytes around the mark:
by the half of the remaining bytes before what they share, and by the half after it, as equal windows agree in
one of them. Each context is cut to the bytes that windows around the longer shared string can reach. Groups that are
still too large are dealt again in the same way; when all bytes of a window are shared, the group is that window.

Defined results: null and empty texts have no bytes and keep the hash of the empty string; equal rows are
places of their own, so both lose what they share; a null id is reported as null; an empty table gives
an empty table; further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.shared import stored
from tablewright.llm.suffix_sorting import common_prefixes, suffix_array

GRAM = 32
_TABLE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def _gram_hashes(text: bytes, gram: int) -> np.ndarray:
    h, size = _TABLE[np.frombuffer(text, np.uint8)], 1
    while size < gram:
        h = h[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + (h[size:] ^ (h[size:] >> np.uint64(29)))
        size *= 2
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def marks(texts: list[bytes], length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, mark, first window, number of windows, place of the mark in it) of each run of windows whose first least hash
    is in one place. The texts, each of ``length`` bytes at least, are read as one; windows across their borders are left out."""
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    h = _gram_hashes(b"".join(texts), gram)
    least, width, size = h, length - gram + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:size - width], least[width - size:])
    # a run ends where the value changes, where the place leaves the window, or with its text
    edge = np.r_[True, (least[1:] != least[:-1]) | (h[:len(least) - 1] == least[:-1])]
    stops = starts + sizes - length + 1
    edge[starts], edge[stops[:-1]] = True, True
    new = np.flatnonzero(edge)
    count = np.diff(new, append=len(least))
    text = np.searchsorted(starts, new, "right") - 1
    inside = new < stops[text]
    new, count, text = new[inside], count[inside], text[inside]
    place = np.full(len(new), width - 1)  # a lower hash came in at the end, or the place is looked for
    look = np.flatnonzero((new == starts[text]) | (least[new] >= least[new - 1]))
    place[look] = np.lib.stride_tricks.sliding_window_view(h, width)[new[look]].argmin(1)
    return text, least[new].view(np.int64), new - starts[text], count, place


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        z = pa.array([pa.compress(t.as_buffer(), "zstd", asbytes=True) for t in batch.column(4)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], z], names=["id", "k1", "k2", "n", "z"])


def _unpacked(z: bytes, n: int) -> bytes:
    return pa.decompress(z, n, "zstd", asbytes=True) if n else b""


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return edge[::2], edge[1::2]


def repeated(contexts: list[bytes], places: list[int], length: int) -> list[np.ndarray]:
    """For each context which of its windows share ``length`` bytes with another suffix of the shard or stand for several places."""
    sizes = np.array([len(c) for c in contexts])
    t = np.frombuffer(b"\0".join(contexts), np.uint8).astype(np.int32) + 1
    starts = np.cumsum(sizes + 1) - sizes - 1
    t[starts[1:] - 1] = 0  # a letter below all bytes ends each context
    sa = suffix_array(t, 257)
    before, shared = common_prefixes(t, sa, starts, 4 * length)
    hit = shared >= length
    flags = hit.copy()
    flags[before[hit]] = True
    many = np.array(places) > 1
    return [flags[s:s + n - length + 1] | m for s, n, m in zip(starts, sizes, many)]


def _deal(groups: DataFrame, length: int) -> DataFrame:
    """Rows of a group (g) in the groups by half of the remaining bytes before (a) and after (b) the shared string at ``p``."""
    rest = F.lit(length) - F.col("a") - F.col("b")
    half = F.ceil(rest / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), (F.col("a") + half).alias("a"), F.col("b").alias("b")),
        F.struct(F.lit(1).alias("side"), F.col("a").alias("a"), (F.col("b") + half).alias("b")))
    dealt = groups.withColumn("x", F.explode(sides)).where("x.a <= p AND p + x.b <= length(context)")
    dealt = dealt.withColumn("g", F.expr(
        "CASE x.side WHEN 0 THEN xxhash64(g, 0, substring(context, p - x.a + 1, x.a - a)) ELSE xxhash64(g, 1, substring(context, p + b + 1, x.b - b)) END"))
    dealt = dealt.withColumn("a", F.col("x.a")).withColumn("b", F.col("x.b")).drop("x")
    reach = F.lit(length) - F.col("a") - F.col("b")
    lo = F.greatest(F.lit(0), F.col("p") - F.col("a") - reach)
    hi = F.least(F.length("context"), F.col("p") + F.col("b") + reach)
    dealt = dealt.withColumn("lo", lo).withColumn("context", F.substring("context", lo + 1, hi - lo)).withColumn(
        "from", F.col("from") + F.col("lo")).withColumn("p", F.col("p") - F.col("lo")).drop("lo")
    return dealt.where(F.length("context") >= length)


def _sized(groups: DataFrame) -> DataFrame:
    """The rows of groups of several places with the bytes of their group."""
    size = groups.groupBy("g").agg(F.sum(F.length("context")).alias("bytes"), F.sum("n").alias("places"))
    return groups.join(size.where("places > 1").drop("places"), "g")


def repeated_windows(contexts: DataFrame, length: int, shard_bytes: int, mark_bytes: int) -> DataFrame:
    """(mark, digest, lo, hi): ranges of repeated windows in each different context (mark, digest, p, l, r, context, n)."""
    side = contexts.select("mark", "digest", "n", F.explode(F.array("l", "r")).alias("x")).where("x IS NOT NULL")
    shared = side.groupBy("mark", "x").agg(F.sum("n").alias("c")).where("c > 1").drop("c")
    near = side.join(shared, ["mark", "x"]).select("mark", "digest").distinct()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, places, total, last = [], [], [], 0, None

        def done() -> pa.RecordBatch:
            out = ([], [], [], [])
            for (mark, digest, start), flags in zip(names, repeated(held, places, length)):
                lo, hi = _runs(flags)
                out[0].extend([mark] * len(lo))
                out[1].extend([digest] * len(lo))
                out[2].extend((lo + start).tolist())
                out[3].extend((hi + start).tolist())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=["mark", "digest", "lo", "hi"])

        for batch in batches:
            for g, mark, digest, n, start, context in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if g != last and total >= shard_bytes:
                    yield done()
                    names, held, places, total = [], [], [], 0
                last = g
                names.append((mark, digest, start))
                held.append(context)
                places.append(n)
                total += len(context)
        if held:
            yield done()

    groups = contexts.join(near, ["mark", "digest"], "left_semi").select(
        F.col("mark").alias("g"), "mark", "digest", "n", F.lit(0).alias("from"), "context", "p", F.lit(0).alias("a"), F.lit(GRAM).alias("b"))
    equal = None
    if not contexts.groupBy("mark").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > mark_bytes).isEmpty():
        left, ready = stored(_sized(groups), "groups"), []
        for _ in range(length.bit_length() + 1):
            ready.append(left.where(F.col("bytes") <= mark_bytes))
            large = left.where(F.col("bytes") > mark_bytes)
            whole = large.where(F.col("a") + F.col("b") == length)
            start = (F.col("from") + F.col("p") - F.col("a")).cast("long")
            whole = whole.select("mark", "digest", start.alias("lo"), (start + 1).alias("hi"))
            equal = whole if equal is None else equal.union(whole)
            left = stored(_sized(_deal(large.where(F.col("a") + F.col("b") < length).drop("bytes"), length)), "groups")
            if left.isEmpty():
                break
        groups = ready[0]
        for more in ready[1:]:
            groups = groups.union(more)
    out = groups.select("g", "mark", "digest", "n", "from", "context").repartition("g").sortWithinPartitions("g").mapInArrow(
        shards, "mark long, digest binary, lo long, hi long")
    return out if equal is None else out.union(equal)


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, length: int = 200, shard_bytes: int = 2_000_000,
    mark_bytes: int = 32_000_000, with_text: bool = True,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, the kept bytes."""
    key = ["k1", "k2"]  # 128 bits tell texts apart
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(id).alias("id"), body.alias("t")).withColumn("k1", F.xxhash64("t")).withColumn(
        "k2", F.xxhash64(F.lit(1), F.md5("t"))).withColumn("n", F.length("t"))
    long_ = rows.where(F.col("n") >= length)

    def packed(texts: DataFrame) -> DataFrame:
        """The texts as they travel: compressed (``z``)."""
        fields = [texts.schema["id"], *(T.StructField(c, T.LongType()) for c in key), T.StructField("n", T.IntegerType()), T.StructField("z", T.BinaryType())]
        return texts.select("id", *key, "n", "t").mapInArrow(_pack, T.StructType(fields))

    def found_in(keys: list[tuple[int, int]], texts: list[bytes]) -> pa.RecordBatch:
        parts, held, size = [], 0, 0
        for i, value in enumerate(texts):
            size += len(value)
            if size >= 1 << 16 or i == len(texts) - 1:  # as much as caches hold
                text, *columns = marks(texts[held:i + 1], length)
                parts.append((text + held, *columns))
                held, size = i + 1, 0
        text, mark, s, m, p = (np.concatenate(c) for c in zip(*parts))
        k1, k2 = np.array(keys, np.int64)[text].T
        # a mark that is seen again here is frequent: one row of it tells the other tasks, the others stand for themselves
        _, first, kind, many = np.unique(mark, return_index=True, return_inverse=True, return_counts=True)
        again = many[kind] > 1
        seen = np.where(again, 0, 1)
        seen[first] = np.minimum(many, 2)
        lane = np.where(seen > 0, 0, ((k1 ^ s) & 0xFFFF) + 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(t)) for c, t in zip((k1, k2, mark, s, m, p, lane, seen), (np.int64,) * 3 + (np.int32,) * 4 + (np.int8,))],
            names=["k1", "k2", "mark", "s", "m", "p", "lane", "seen"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for k1, k2, value in zip(*(column.to_pylist() for column in batch.columns)):
                keys.append((k1, k2))
                texts.append(value)
                size += len(value)
                if size > 16_000_000:
                    yield found_in(keys, texts)
                    keys, texts, size = [], [], 0
        if texts:
            yield found_in(keys, texts)

    found = long_.select(*key, "t").mapInArrow(find, "k1 long, k2 long, mark long, s int, m int, p int, lane int, seen byte")
    often = found.withColumn("c", F.sum("seen").over(Window.partitionBy("mark", "lane"))).where("seen <> 1 OR c > 1")
    flagged = often.groupBy(*key).agg(F.collect_set(F.struct("mark", "s", "m", "p")).alias("marks"))
    classes = rows.where(F.col("n") >= length).groupBy(*key).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    wing = (length - GRAM) // 2
    # rows that share id and text stand twice here, which changes no decision: their contexts have several places anyhow
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, copies, n, z, lists = batch.columns
            mark, s, m, p = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            ends = np.cumsum(lists.value_lengths().to_numpy())
            rows, texts, size, lo = [], [], 0, 0
            for row, (end, count) in enumerate(zip(ends.tolist(), lists.value_lengths().to_pylist())):
                value = _unpacked(z[row].as_py(), n[row].as_py())
                own = [value[i:i + j + length - 1] for i, j in zip(s[end - count:end].tolist(), m[end - count:end].tolist())]
                rows += [row] * count
                texts += own
                size += sum(map(len, own))
                if size > 8_000_000 or row == len(ends) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [*(c.take(pa.array(rows, pa.int64())) for c in (k1, k2, copies)), *(pa.array(c[lo:end]) for c in (mark, s, p)),
                         pa.array(texts, pa.binary()), pa.array([hashlib.md5(c).digest() for c in texts], pa.binary())],
                        names=["k1", "k2", "copies", "mark", "s", "p", "context", "digest"])
                    rows, texts, size, lo = [], [], 0, end

    contexts = stored(packed(long_).join(flagged.join(classes, key), key).where(F.col("id").eqNullSafe(F.col("rep"))).select(
        *key, "copies", "n", "z", "marks").mapInArrow(
            cut_out, "k1 long, k2 long, copies long, mark long, s int, p int, context binary, digest binary"), "contexts", compression="zstd")
    kinds = contexts.groupBy("mark", "digest").agg(
        F.sum("copies").alias("n"), F.first("p").alias("p"), F.first(F.length("context")).alias("size"),
        F.first(F.expr(f"CASE WHEN p >= {wing} THEN xxhash64(0, substring(context, p - {wing} + 1, {wing + GRAM})) END")).alias("l"),
        F.first(F.expr(f"CASE WHEN p + {GRAM + wing} <= length(context) THEN xxhash64(1, substring(context, p + 1, {GRAM + wing})) END")).alias("r"),
        F.first("context").alias("context"))
    ranges = repeated_windows(kinds, length, shard_bytes, mark_bytes)
    spans = contexts.select(*key, "mark", "s", "digest").join(ranges, ["mark", "digest"]).groupBy(*key).agg(
        F.collect_set(F.struct((F.col("s") + F.col("lo")).alias("lo"), (F.col("s") + F.col("hi")).alias("hi"))).alias("windows"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [], [])
            for n, z, windows in zip(*(column.to_pylist() for column in batch.columns[1:])):
                value = kept = _unpacked(z, n)
                removed, n_spans = 0, 0
                if windows:
                    edge = np.zeros(len(value) + 1, np.int64)
                    np.add.at(edge, [w["lo"] for w in windows], 1)
                    np.add.at(edge, [w["hi"] + length - 1 for w in windows], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept, removed, n_spans = np.frombuffer(value, np.uint8)[~gone].tobytes(), int(gone.sum()), len(_runs(gone)[0])
                for column, x in zip(out, (len(value), removed, n_spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))], schema_names)

    schema_names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)]
                          + [T.StructField(c, T.LongType()) for c in schema_names[1:4]]
                          + [T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])
    done = packed(rows).join(spans, key, "left").select("id", "n", "z", "windows").mapInArrow(cut, schema)
    return done.select(F.col("id").alias(id), *schema_names[1:5 + with_text])
