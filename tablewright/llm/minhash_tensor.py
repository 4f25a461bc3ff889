"""MinHash near-dedup with tensored banding; every link is confirmed on the full shingle sets.

Two collections of ``parts`` hashes are made, each hash of ``rows`` minhashes. A table key is a pair of
one hash from either, so ``2 * parts * rows`` minhashes serve ``parts ** 2`` tables of ``2 * rows``
minhashes each. Two sets of similarity s share a table unless all hashes of one collection differ,
that is with probability ``(1 - (1 - s ** rows) ** parts) ** 2``: 0.9999 at 0.8 with the defaults
(14 parts of 3 rows: 84 minhashes instead of 1176), and more above.

Sets are handled once: documents of equal sets form a class before any key is made. Then

1. keys are grouped by one shuffle; keys that only one class has go no further. Equal keys within a
   batch are joined up before the shuffle, so a key that a third of all rows share costs one
   row per batch;
2. each group links to its smallest class (a star); links are verified and joined to components;
3. classes with too many shingles that no other open class has are done; other groups that still hold several components get another star, around a random class of each group;
4. what still lies in one group but in different components is compared pair by pair inside the task, by
   signature and by the rarest quarter of either set; only pairs that can be links by these go on to the
   test on the full sets.

A pair whose ends are in one component already needs no test, so a dense group costs about as
many tests as it has members, and no pair that could change the result is left out.

Defined results: null and empty texts have no shingles and are linked with nothing; a null id takes no
part and is its own component; equal rows fall in one class; an empty table gives an empty table;
further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.components import components
from tablewright.llm.shared import stored

_MIX, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; A-Z count as a-z, words end at ASCII white space."""
    from xxhash import xxh3_64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    x = _mixed(h[:len(h) - size + 1] + np.uint64(size))
    for k in range(1, size):
        x = _mixed(x * _STEP + h[k:len(h) - size + 1 + k])
    return np.unique(x)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), 0xFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 2048):
        block = (shingles[i:i + 2048, None] * factors[None, :]) >> np.uint64(32)
        np.minimum(least, block.min(axis=0), out=least)
    return least.astype(np.uint32)


def part_hashes(signatures: np.ndarray, parts: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the first and of the second collection, one row per signature."""
    h = np.zeros((len(signatures), 2 * parts), np.uint64)
    for r in range(rows):
        h = _mixed(h * _STEP + signatures[:, r::rows].astype(np.uint64) + np.uint64(r))
    first = _mixed(h[:, :parts] + np.arange(1, parts + 1, dtype=np.uint64) * _STEP)
    second = _mixed(h[:, parts:] + np.arange(1, parts + 1, dtype=np.uint64) * _MIX)
    return first, second


def table_keys(signatures: np.ndarray, parts: int, rows: int) -> np.ndarray:
    """Keys of all tables, one row per signature: every pair of a hash of the first and of the second collection."""
    first, second = part_hashes(signatures, parts, rows)
    return _mixed(first[:, :, None] * _STEP + second[:, None, :]).reshape(len(signatures), -1)


def sketches(docs: DataFrame, id: str, text: str, shingle: int, parts: int, rows: int) -> DataFrame:
    """Stored: doc, n_shingles, set_key (hash of the whole set) and signature."""
    factors = np.random.default_rng(8).integers(0, 1 << 63, 2 * parts * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, key, sig = [], [], []
            for value in batch.column(1):
                x = shingle_set(value.as_py(), shingle)
                size.append(len(x))
                key.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                sig.append(signature(x, factors).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc", "n_shingles", "set_key", "sig"])

    return stored(docs.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("binary").alias("t")).mapInArrow(
        run, "doc long, n_shingles long, set_key binary, sig binary"), "sketches")


def _grouped(classes: DataFrame, parts: int, rows: int) -> DataFrame:
    """Stored: (key, cls, rep) for every class that shares a key; rep is the smallest known class of the key.

    ``spread`` is the key for rows that must meet and a hash of the class for rows that have met their rep
    within the batch, so the latter go anywhere.
    """
    names = ["spread", "cls", "key", "rep"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cls = batch.column(0).to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(cls), -1)
            order = np.argsort(cls, kind="stable")
            cls, keys = cls[order], table_keys(sig[order], parts, rows).view(np.int64)
            key, who = keys.ravel(), np.repeat(cls, keys.shape[1])
            by = np.argsort(key, kind="stable")
            key, who = key[by], who[by]
            first = np.r_[True, key[1:] != key[:-1]]
            rep = who[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            spread = np.where(first, key, _mixed(who.view(np.uint64)).view(np.int64))
            bare = first & np.r_[first[1:], True]  # met nobody: the key column is left out as well
            for i in range(0, len(key), 100_000):
                part = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([
                    pa.array(spread[part]), pa.array(who[part]), pa.array(key[part], mask=bare[part]),
                    pa.array(rep[part], mask=first[part])], names=names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head, waiting = None, 0, False  # key of the open run, its first class, whether that is unreported
        for batch in batches:
            key, cls = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            there = np.asarray(batch.column(3).is_valid())
            out = [(batch.column(2).filter(pa.array(there)).to_numpy(), cls[there], batch.column(3).filter(pa.array(there)).to_numpy())]
            joined = np.asarray(batch.column(2).is_valid())[~there]  # has met others already
            key, cls = key[~there], cls[~there]
            if len(key):
                start = np.r_[last is None or key[0] != last, key[1:] != key[:-1]]
                at = np.maximum.accumulate(np.where(start, np.arange(len(key)), -1))
                rep = np.where(at < 0, head, cls[at])
                follows = np.r_[~start[1:], False]
                if waiting and not start[0]:
                    out.append((key[:1], np.array([head]), np.array([head])))
                keep = ~start | follows | joined
                out.append((key[keep], cls[keep], rep[keep]))
                last, head, waiting = key[-1], rep[-1], bool(start[-1] and not joined[-1])
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "cls", "rep"])

    spread = classes.select("cls", "sig").mapInArrow(emit, "spread long, cls long, key long, rep long")
    return stored(
        spread.repartition("spread").sortWithinPartitions("spread", "cls").mapInArrow(meet, "key long, cls long, rep long"), "groups")


def _shingles(docs: DataFrame, id: str, text: str, classes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """Stored: the full set of every wanted class, from the text of its smallest document."""
    from_docs = docs.select(F.col(id).cast("long").alias("rep"), F.col(text).cast("binary").alias("t"))
    side = classes.select("cls", "rep", "set_key").join(wanted, "cls", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, sets = [], []
            for c, key, value in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                x = shingle_set(value.as_py(), shingle)
                if hashlib.blake2b(x.tobytes(), digest_size=16).digest() == key.as_py():
                    cls.append(c)
                    sets.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "shingles"])

    found = from_docs.join(side, "rep").select("cls", "set_key", "t").mapInArrow(run, "cls long, shingles binary")
    return stored(found.dropDuplicates(["cls"]), "shingles")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored: the pairs (a, b) whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(i) for i in (2, 3))
            keep = []
            for p, q in zip(x, y):
                p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                small, large = (p, q) if len(p) <= len(q) else (q, p)
                if 100 * len(small) < percent * len(large):
                    keep.append(False)
                    continue
                at = np.searchsorted(large, small)
                shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    one, two = (sets.select(F.col("cls").alias(n), F.col("shingles").alias(f"{n}_set")) for n in ("a", "b"))
    return stored(pairs.join(one, "a").join(two, "b").select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long"), "links")


def _able(sets: DataFrame, wanted: DataFrame, percent: int) -> DataFrame:
    """Stored: (cls, n, common, rare, last) of the wanted classes that can still have a link among themselves.

    ``common`` counts the shingles that another wanted class has as well. A link needs that share of
    the own set, so a class with more shingles of its own can be left out whatever its partners are.
    ``rare`` is the first quarter of the set (and one more) in one order for all sets, rare shingles first, cut to
    32 bits; ``last`` is the place of its last shingle in that order. Rarity is read from a table of 2^18 sums.
    """
    slots = 1 << 18

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(slots, np.int64)
        for batch in batches:
            for x in batch.column(0):
                held += np.bincount((np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(46)).astype(np.int64), minlength=slots)
        there = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(held[there])], names=["slot", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            each = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            who = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in each])
            value, first, count = np.unique(np.concatenate(each), return_index=True, return_counts=True)
            for i in range(0, len(value), 100_000):
                part = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[part].view(np.int64)), pa.array(who[first[part]]), pa.array(count[part])], names=["x", "cls", "c"])

    inside = sets.join(wanted, "cls", "left_semi")
    alone = inside.mapInArrow(run, "x long, cls long, c long").groupBy("x").agg(F.min("cls").alias("cls"), F.sum("c").alias("c")).where(
        "c = 1").groupBy("cls").agg(F.count(F.lit(1)).alias("alone"))
    counted = inside.select("cls", (F.length("shingles") / 8).cast("long").alias("n")).join(alone, "cls", "left").select(
        "cls", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))
    often = np.zeros(slots, np.int64)
    for r in inside.select("shingles").mapInArrow(tally, "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).collect():
        often[r["slot"]] = r["c"]

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare, last = [], []
            for x in batch.column(3):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                c = often[(x >> np.uint64(46)).astype(np.int64)]
                first = np.lexsort((x, c))[:len(x) // 4 + 1]
                rare.append(np.sort(x[first].astype(np.uint32)).tobytes())
                last.append(f"{c[first[-1]]:020d}{x[first[-1]]:020d}")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(rare, pa.binary()), pa.array(last, pa.string())], names=["cls", "n", "common", "rare", "last"])

    can = counted.where(F.col("common") * 100 >= F.col("n") * percent).join(sets, "cls").select("cls", "n", "common", "shingles")
    return stored(can.mapInArrow(rarest, "cls long, n long, common long, rare binary, last string"), "able")


def _open_pairs(open_: DataFrame, able: DataFrame, classes: DataFrame, parts: int, rows: int, percent: int, block: int = 1024) -> DataFrame:
    """Pairs (a, b) of one key and different labels whose signatures allow the similarity, each from one table.

    A large group is dealt in blocks, and each pair of blocks is a unit of its own, so no task holds more than
    two blocks. Of the tables that two classes share only the first gives the pair. Signatures that agree
    in fewer places than all but one in 100,000 pairs at the threshold would are passed over.
    """
    share = percent / 100
    total = 2 * parts * rows
    least = int(np.floor(total * share - 4.3 * np.sqrt(total * share * (1 - share))))
    sized = open_.join(open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "key")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    units = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "cls", "label")

    def may(p: np.ndarray, p_last: str, p_n: int, q: np.ndarray, q_last: str, q_n: int) -> bool:
        """What the first quarters share, and all that comes after in the set whose quarter ends first, bounds the intersection."""
        at = np.minimum(np.searchsorted(q, p), len(q) - 1)
        most = int((q[at] == p).sum()) + (p_n - len(p) if p_last <= q_last else q_n - len(q))
        return most * (100 + percent) >= percent * (p_n + q_n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(unit: tuple, held: list) -> pa.RecordBatch:
            own_, cls, label, n, common = (np.array(c) for c in list(zip(*held))[:5])
            rare, last = [np.frombuffer(h[6], np.uint32) for h in held], [h[7] for h in held]
            sig = np.frombuffer(b"".join(h[5] for h in held), np.uint32).reshape(len(held), -1)
            first, second = part_hashes(sig, parts, rows)
            out = ([], [])
            left = np.flatnonzero(own_ == unit[1])
            right = np.flatnonzero(own_ == unit[2])
            for x in left:
                y = right[(label[right] != label[x]) & ((cls[right] > cls[x]) if unit[1] == unit[2] else True)]
                if not len(y):
                    continue
                # the intersection is at most the smaller of what either has in common with anybody
                most = np.minimum(np.minimum(common[y], common[x]), np.minimum(n[y], n[x]))
                y = y[most * (100 + percent) >= percent * (n[y] + n[x])]
                y = y[(sig[y] == sig[x]).sum(1) >= least]
                if not len(y):
                    continue
                i, j = (first[y] == first[x]).argmax(1), (second[y] == second[x]).argmax(1)
                y = y[_mixed(first[x][i] * _STEP + second[x][j]).view(np.int64) == unit[0]]
                y = y[[may(rare[x], last[x], n[x], rare[z], last[z], n[z]) for z in y.tolist()]] if len(y) else y
                out[0].append(np.minimum(cls[x], cls[y]))
                out[1].append(np.maximum(cls[x], cls[y]))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64)) for c in out], names=["a", "b"])

        unit, held = None, []
        for batch in batches:
            for key, lo, hi, *rest in zip(*(batch.column(i).to_pylist() for i in range(11))):
                if (key, lo, hi) != unit:
                    if len(held) > 1:
                        yield pairs(unit, held)
                    unit, held = (key, lo, hi), []
                held.append(rest)
        if len(held) > 1:
            yield pairs(unit, held)

    sketch = able.join(classes.select("cls", "sig"), "cls")
    return units.join(sketch, "cls").select("key", "lo", "hi", "own", "cls", "label", "n", "common", "sig", "rare", "last").repartition(
        "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, shingle: int = 5, percent: int = 80, parts: int = 14, rows: int = 3,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id that links reach) and kept."""
    sk = sketches(docs, id, text, shingle, parts, rows)
    classes = stored(
        sk.where("set_key IS NOT NULL AND doc IS NOT NULL").groupBy("set_key").agg(F.min(F.struct("doc", "sig")).alias("m"))
        .select(F.monotonically_increasing_id().alias("cls"), "set_key", F.col("m.doc").alias("rep"), F.col("m.sig").alias("sig")), "classes")
    groups = _grouped(classes, parts, rows)
    sets = _shingles(docs, id, text, classes, groups.select("cls").distinct(), shingle)

    def pair(a: str, b: str) -> list:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    tested = stored(groups.where("cls <> rep").select(*pair("cls", "rep")).distinct(), "pairs")
    links = _verified(tested, sets, percent)
    able = None
    for whole in (False, True):
        label = components(links)
        held = groups.select("key", "cls") if able is None else groups.select("key", "cls").join(able.select("cls"), "cls", "left_semi")
        held = held.join(label.withColumnRenamed("node", "cls"), "cls", "left").select(
            "key", "cls", F.coalesce("label", "cls").alias("label"))
        mixed = held.groupBy("key").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct(F.xxhash64("cls", "key"), "cls", "label")).alias("pick"))
        open_ = stored(held.join(mixed.where("lo <> hi").select("key", "pick.cls", "pick.label").toDF("key", "r", "r_label"), "key"), "open")
        if able is None:
            able = _able(sets, open_.select("cls").distinct(), percent)
            open_ = open_.join(able.select("cls"), "cls", "left_semi")
        if whole:
            near = _open_pairs(open_.select("key", "cls", "label"), able, classes, parts, rows, percent)
        else:
            near = open_.where("label <> r_label").select(*pair("cls", "r"))
        fresh = stored(near.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        links = stored(links.union(_verified(fresh, sets, percent)), "links")
        tested = stored(tested.union(fresh), "tested")
    label = components(links)
    joined = classes.select("cls", "set_key", "rep").join(label.withColumnRenamed("node", "cls"), "cls", "left").select(
        "set_key", "rep", F.coalesce("label", "cls").alias("label"))
    smallest = joined.groupBy("label").agg(F.min("rep").alias("component"))
    named = joined.join(smallest, "label").select("set_key", "component")
    out = sk.select("doc", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.coalesce("component", "doc")
    return out.select(
        F.col("doc").alias(id), "n_shingles", component.alias("component_id"),
        (F.col("doc").isNull() | (F.col("doc") == component)).alias("kept"))
