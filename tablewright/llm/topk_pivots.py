"""Exact top-k by integer inner product over a pivot-distance index.

Inner products become distances: each vector gets one more component so that all have the norm of the
longest, queries get zero there, and a larger product is a smaller distance. A vector is keyed by its
nearest pivot and the distance to it. Sorted by this key, the vectors are cut into blocks, each a
ring (annulus) around one pivot. For a query at distance d from a pivot and with k vectors known
within r, the triangle inequality allows better ones only at distances d - r to d + r from that pivot.

* Pivots come from a bounded sample (``sample`` vectors), which also gives each query its first r.
* Queries are put in blocks the same way; a pair of a query block and a ring that no query of the
  block can reach is never formed. The join runs on the pivot, with the ring limits as filter.
* Pairs of a query block are worked off nearest ring first; r shrinks with what was found, and rings
  out of reach by then are skipped. Rings of a pivot are dealt over ``lanes`` tasks per query block. The vectors of a
  block travel once per lane, those of a ring once per block in reach, in the narrowest integers that hold them.

All vectors are indexed and the result is exact. Only the sample, and the largest length and norm,
reach the driver; blocks have a fixed number of rows whatever the number of equal vectors, as ties
in distance are cut by id.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors
count as filled up with zeros; equal scores rank by smaller id; rows of a query's own id are no candidates;
a repeated id is a candidate per row and a query per row, each query row with ranks of its own (equal query rows give
equal rows); with fewer than k candidates all are returned; an empty table
gives an empty table; further columns are not read. Components must be integers, products below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.shared import stored

RESULT = "query_id long, rank int, vec_id long, score long"


def integer_vectors(df: DataFrame, id: str, vector: str, factor: int) -> DataFrame:
    """(id, vec): components times ``factor`` rounded down, in doubles; unusable vectors are left out."""
    x = F.transform(vector, lambda v: v.cast("double"))
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).where(usable).select(
        F.col(id).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * factor).cast("double")).alias("vec"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, filled up with zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out


def narrowest(largest: float) -> np.dtype:
    """The smallest type for integers of at most that absolute value."""
    return np.dtype(np.int8 if largest < 2 ** 7 else np.int16 if largest < 2 ** 15 else np.int32 if largest < 2 ** 31 else np.float64)


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(norm - (x * x).sum(1), 0))]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0))


def choose_pivots(sample: np.ndarray, pivots: int, rounds: int = 5) -> np.ndarray:
    """Centres of the sample: random starts and a few rounds of means."""
    centres = sample[np.random.default_rng(1).permutation(len(sample))[:pivots]]
    for _ in range(rounds):
        near = _distances(sample, centres).argmin(1)
        centres = np.stack([sample[near == p].mean(0) if (near == p).any() else centres[p] for p in range(len(centres))])
    return centres


def top_k(
    points: DataFrame, queries: DataFrame, k: int = 20, *, pivots: int = 32, sample: int = 2048, ring_rows: int = 4096,
    query_rows: int = 2048, lanes: int = 16,
) -> DataFrame:
    """(query_id, rank, vec_id, score) from two tables of (id, vec)."""
    spark = points.sparkSession
    square = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)
    largest = F.aggregate("vec", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))
    dim, norm, most = points.agg(F.max(F.size("vec")), F.max(square), F.max(largest)).first()
    if dim is None:
        return spark.createDataFrame([], RESULT)
    most = max(most, queries.agg(F.max(largest)).first()[0] or 0.0)
    kind = narrowest(most)
    taken = points.orderBy(F.xxhash64("id", "vec"), "id").limit(sample).collect()
    known_ids = np.array([r["id"] for r in taken])
    known = np.zeros((len(taken), dim))
    for i, r in enumerate(taken):
        known[i, :len(r["vec"])] = r["vec"]
    centres = choose_pivots(_lifted(known, norm), pivots)
    slack = 1e-6 * (1 + np.sqrt(norm))

    def key(is_query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), dim)
                d = _distances(np.c_[x, np.zeros(len(x))] if is_query else _lifted(x, norm), centres)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near]), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())],
                    names=["id", "pivot", "d", "vec"])
        return run

    def keyed(df: DataFrame, is_query: bool) -> DataFrame:
        return df.select("id", "vec").mapInArrow(key(is_query), "id long, pivot int, d double, vec binary").repartitionByRange(
            "pivot", "d", "id").sortWithinPartitions("pivot", "d", "id")

    def blocks(batches: Iterator[pa.RecordBatch], rows: int, by_pivot: bool) -> Iterator[tuple]:
        ids, ds, vecs, now = [], [], [], None
        for batch in batches:
            for i, p, d, v in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if ids and (len(ids) >= rows or (by_pivot and p != now)):
                    yield now, ids, ds, vecs
                    ids, ds, vecs = [], [], []
                now = p
                ids.append(i)
                ds.append(d)
                vecs.append(v)
        if ids:
            yield now, ids, ds, vecs

    def rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, ids, ds, vecs in blocks(batches, ring_rows, True):
            yield pa.RecordBatch.from_pydict({
                "pivot": pa.array([p], pa.int32()), "dmin": [ds[0]], "dmax": [ds[-1]], "ids": [np.array(ids).tobytes()], "vecs": [b"".join(vecs)]})

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, _, vecs in blocks(batches, query_rows, False):
            x = np.frombuffer(b"".join(vecs), kind).reshape(len(ids), dim).astype(float)
            score = x @ known.T
            score[np.array(ids)[:, None] == known_ids[None, :]] = -np.inf
            floor = np.full(len(ids), -np.inf) if len(known) < k else np.partition(score, -k, axis=1)[:, -k]
            d = _distances(np.c_[x, np.zeros(len(x))], centres)
            r = np.sqrt(np.maximum((x * x).sum(1) + norm - 2 * floor, 0)) + slack
            yield pa.RecordBatch.from_pydict({
                "ids": [np.array(ids).tobytes()], "vecs": [b"".join(vecs)], "floor": [floor.tobytes()],
                "lo": pa.array([(d - r[:, None]).min(0).tolist()], pa.list_(pa.float64())), "hi": pa.array([(d + r[:, None]).max(0).tolist()], pa.list_(pa.float64())),
                "mid": pa.array([d.mean(0).tolist()], pa.list_(pa.float64()))})

    ring = stored(keyed(points, False).mapInArrow(rings, "pivot int, dmin double, dmax double, ids binary, vecs binary").withColumn(
        "ring", F.monotonically_increasing_id()), "rings")
    ask = stored(keyed(queries, True).mapInArrow(
        asked, "ids binary, vecs binary, floor binary, lo array<double>, hi array<double>, mid array<double>").withColumn(
        "ask", F.monotonically_increasing_id()), "asked")
    reach = ask.select("ask", F.posexplode(F.arrays_zip("lo", "hi", "mid")).alias("pivot", "x")).select("ask", "pivot", "x.*")
    pairs = reach.join(ring.select("ring", "pivot", "dmin", "dmax"), "pivot").where("dmax >= lo AND dmin <= hi").select(
        "ask", "ring", (F.col("ring") % lanes).alias("lane"),
        F.greatest(F.col("dmin") - F.col("mid"), F.col("mid") - F.col("dmax"), F.lit(0.0)).alias("gap"))
    # per block and lane one row with the queries, which sorts first, and one row per ring
    nothing = F.lit(None)
    heads = pairs.select("ask", "lane").distinct().join(ask.select("ask", "ids", "vecs", "floor"), "ask").select(
        "ask", "lane", F.lit(-1.0).alias("gap"), F.lit(-1).alias("pivot"), nothing.cast("double").alias("dmin"), nothing.cast("double").alias("dmax"), "ids", "vecs", "floor")
    work = heads.unionByName(pairs.join(ring.select("ring", "pivot", "dmin", "dmax", "ids", "vecs"), "ring").select(
        "ask", "lane", "gap", "pivot", "dmin", "dmax", "ids", "vecs", nothing.cast("binary").alias("floor")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state = None, None

        def best() -> None:
            """Keeps the k best found for each query and raises its floor."""
            q, i, s = (np.concatenate(c) for c in zip(*state["found"]))
            order = np.lexsort((i, -s, q))
            q, i, s = q[order], i[order], s[order]
            first = np.r_[True, q[1:] != q[:-1]]
            rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
            keep = rank < k
            state["found"], state["n"] = [(q[keep], i[keep], s[keep])], int(keep.sum())
            last = rank == k - 1
            state["floor"][q[last]] = np.maximum(state["floor"][q[last]], s[last])

        def out() -> Iterator[pa.RecordBatch]:
            if state and state["n"]:
                best()
                q, i, s = state["found"][0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(q), group[0])), pa.array(q), pa.array(state["ids"][q]), pa.array(i), pa.array(s.astype(np.int64))],
                    names=["ask", "row", "query_id", "vec_id", "score"])

        for batch in batches:
            for row in range(batch.num_rows):
                ask_, lane, _, p, dmin, dmax, ids, vecs, floor = (batch.column(c)[row].as_py() for c in range(9))
                ids = np.frombuffer(ids, np.int64)
                x = np.frombuffer(vecs, kind).reshape(len(ids), dim).astype(float)
                if (ask_, lane) != group:
                    yield from out()
                    group = ask_, lane
                    state = {"ids": ids, "x": x, "floor": np.frombuffer(floor).copy(), "found": [], "n": 0,
                             "d": _distances(np.c_[x, np.zeros(len(x))], centres), "size": (x * x).sum(1) + norm}
                    continue
                r = np.sqrt(np.maximum(state["size"] - 2 * state["floor"], 0)) + slack
                d = state["d"][:, p]
                near = np.flatnonzero((d - r <= dmax) & (d + r >= dmin))
                if not len(near):
                    continue
                score = state["x"][near] @ x.T
                a, b = np.nonzero(score >= state["floor"][near][:, None])
                ok = state["ids"][near[a]] != ids[b]
                a, b = a[ok], b[ok]
                if len(a):
                    state["found"].append((near[a], ids[b], score[a, b]))
                    state["n"] += len(a)
                    if state["n"] > 8 * k * len(state["ids"]):
                        best()
        yield from out()

    found = work.repartition("ask", "lane").sortWithinPartitions("ask", "lane", "gap").mapInArrow(
        search, "ask long, row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("ask", "row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
