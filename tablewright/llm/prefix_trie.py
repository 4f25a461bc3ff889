"""The trie of conversation prefixes, made from padded matrices of turn ids.

A node is a distinct sequence of first turns; its members are the conversations that begin with it.

*Chunks.* A conversation is cut into chunks of ``band_turns`` turns, and a chunk is a row: the 16-byte checksums of its turns
(role and text), their sizes, and the checksum ``P`` of all chunks before it, an exclusive-or over the chunks so that it is a running
sum over short rows. No row and no task holds a whole long conversation, and equal prefixes have equal ``P``.

*Shards.* Chunks are range-sharded by band, ``P``, turns and conversation into shards of about ``shard_rows`` rows, so conversations that
are all alike are spread as well. A task numbers the turns of its shard, pads the numbers to a matrix, sorts it by numpy
lexsort, and accumulates the changes from row to row with OR along the columns: the mask of column ``d`` marks where nodes of depth
``d`` start. ``reduceat`` over those starts aggregates each depth, sums over subtrees go from the deepest column up.

*Recombination.* Only nodes that hold the first or the last row of a shard, or a chunk that is not its conversation's last, can have members or
descendants elsewhere. Their parts are summed by key. What the parts counted ahead of that (a node in ``k`` shards stands ``k`` times
for one representative, a part that looks childless need not be) is a correction that is added to the ancestors in the band. Sums of
deeper bands are added along the chunks of one conversation of the group, by a running sum over its bands. Both are
groupings by key; nothing goes through the driver.

Defined results: turns go by number (null first), then role and text; a null role or text is empty; rows without a conversation id take no
part; repeated rows are turns of their own; conversations without turns are members of the root alone; a table without
conversations gives no node, not even a root; further columns of the input are not read. Turns are told apart by 128-bit checksums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.shared import stored
from tablewright.operators.keys import positions

PART = (
    "depth bigint, key binary, above binary, path array<binary>, open boolean, virtual boolean, low bigint, parent_low bigint, "
    "n_convs bigint, size bigint, n_children bigint, n_leaves bigint, saved bigint, childless bigint, ends array<bigint>, ends_sha256 string"
)
_KINDS = [
    pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(),
]
_NAMES = [x.split()[0] for x in PART.split(", ")]
CHUNK = ("band", "p1", "p2", "keys", "sizes", "more", "conv_id")
NONE = hashlib.sha256().hexdigest()


def numbered_turns(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``conv_id``, ``pos`` from 0, ``key`` (a checksum of role and text) and ``size`` (bytes of the text) of each turn."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = conversations.select(F.col(id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), *said)
    placed = positions(rows.where("conv_id IS NOT NULL"), ["conv_id"], ["turn", "role", "text"], "pos")
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return placed.select("conv_id", "pos", F.unhex(F.md5(whole)).alias("key"), F.octet_length("text").cast("bigint").alias("size"))


def _joined(keys: Column) -> Column:
    return F.aggregate(keys, F.lit(b""), lambda a, x: F.concat(a, x))


def chunks_of(turns: DataFrame, members: DataFrame | None, band_turns: int) -> DataFrame:
    """Stored rows of ``CHUNK``; each conversation has a chunk of band 0, which may be empty."""
    band = F.expr(f"pos div {band_turns}").alias("band")
    gathered = F.sort_array(F.collect_list(F.struct("pos", "key", "size")))
    cut = turns.groupBy("conv_id", band).agg(gathered.alias("t")).select("conv_id", "band", F.col("t.key").alias("keys"), F.col("t.size").alias("sizes"))
    if members is not None:
        idle = members.select("conv_id").distinct().join(cut.where("band = 0").select("conv_id"), "conv_id", "left_anti")
        cut = cut.unionByName(idle.selectExpr("conv_id", "0L AS band", "CAST(array() AS array<binary>) AS keys", "CAST(array() AS array<bigint>) AS sizes"))
    cut = stored(cut, "trie-chunks")
    # Short rows, and only of conversations that fill a band, meet by conversation.
    full = cut.where(f"band > 0 OR size(keys) = {band_turns}")
    code = F.md5(F.concat(F.encode(F.concat(F.col("band").cast("string"), F.lit(":")), "utf-8"), _joined(F.col("keys"))))
    half = [F.conv(F.substring(code, at, 16), 16, -10).cast("bigint").alias(n) for n, at in (("h1", 1), ("h2", 17))]
    along = Window.partitionBy("conv_id").orderBy("band")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    found = full.select("conv_id", "band", *half).select(
        "conv_id", "band", F.lead("band").over(along).isNotNull().alias("more"),
        *[F.expr(f"bit_xor({h})").over(before).alias(p) for h, p in (("h1", "p1"), ("h2", "p2"))],
    )
    nothing = {"more": F.lit(False), "p1": F.lit(0).cast("bigint"), "p2": F.lit(0).cast("bigint")}
    return cut.join(found, ["conv_id", "band"], "left").select(*[F.coalesce(c, nothing[c]).alias(c) if c in nothing else c for c in CHUNK])


def _prefix(p1: int, p2: int) -> int:
    return (p1 % (1 << 64)) << 64 | p2 % (1 << 64)


def _key(prefix: int, state) -> bytes:
    """The key of a node: what stands before its band, and its turns in the band."""
    return (prefix ^ int.from_bytes(state.digest(), "big")).to_bytes(16, "big")


def path_keys(band: int, p1: int, p2: int, keys: list[bytes]) -> list[bytes]:
    """Keys of the nodes on a chunk's path, from the node at which its band begins."""
    prefix, state = _prefix(p1, p2), hashlib.md5(b"%d:" % band)
    out = [prefix.to_bytes(16, "big")]
    for key in keys:
        state.update(key)
        out.append(_key(prefix, state))
    return out


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 for distinct rows of the columns, in their order."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), np.int64)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


class Shard:
    """The chunks of a shard as a sorted matrix."""

    def __init__(self, chunks: pa.Table, band_turns: int):
        numbers = {n: chunks[n].to_numpy() for n in ("band", "p1", "p2", "conv_id", "more")}
        lists = chunks["keys"].combine_chunks()
        flat = b"".join(lists.flatten().to_pylist())
        length = np.array([len(x) for x in lists], np.int64)
        halves = np.frombuffer(flat, ">u8").reshape(-1, 2)
        row = np.repeat(np.arange(len(length)), length)
        column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        width = int(length.max())
        turn = np.zeros((len(length), width), np.int32)  # 0 pads, so a conversation comes before those that go on
        turn[row, column] = 1 + _dense(halves[:, 0], halves[:, 1])
        size = np.zeros((len(length), width), np.int64)
        size[row, column] = chunks["sizes"].combine_chunks().flatten().to_numpy()
        group = _dense(numbers["band"], numbers["p1"], numbers["p2"])
        order = np.lexsort((numbers["conv_id"], *turn.T[::-1], group))
        self.first = (np.cumsum(length) - length)[order]  # where the keys of a row begin
        self.flat, self.turn, self.size, self.length = flat, turn[order], size[order], length[order]
        self.band, self.p1, self.p2, self.conv, self.more = (numbers[n][order] for n in ("band", "p1", "p2", "conv_id", "more"))
        group, self.band_turns, self.width = group[order], band_turns, width
        change = np.ones((len(order), width + 1), bool)
        change[1:, 0] = group[1:] != group[:-1]
        change[1:, 1:] = self.turn[1:] != self.turn[:-1]
        #: Where nodes of each depth begin: at the first column that differs from the row before, and at all after it.
        self.starts = np.logical_or.accumulate(change, axis=1)
        #: Rows whose nodes can have parts in other shards or descendants in other bands.
        self.marked = self.more.astype(bool)
        self.marked[[0, -1]] = True

    def levels(self) -> list[dict[str, np.ndarray]]:
        """Aggregates of the nodes of each depth."""
        out = []
        for d in range(self.width + 1):
            rows = np.flatnonzero(self.length >= d)
            begin = np.flatnonzero(self.starts[rows, d])
            at = rows[begin]
            ending = ((self.length == d) & ~self.more)[rows]
            n = np.diff(np.append(begin, len(rows)))
            ends = np.add.reduceat(ending.astype(np.int64), begin)
            level = {
                "row": at, "begin": begin, "rows": rows, "n": n, "ending": ending, "ends": ends,
                "low": np.minimum.reduceat(self.conv[rows], begin), "open": np.logical_or.reduceat(self.marked[rows], begin),
                "size": self.size[at, d - 1] if d else np.zeros(len(at), np.int64), "childless": (n == ends).astype(np.int64),
                "virtual": (self.band[at] > 0) if d == 0 else np.zeros(len(at), bool),
            }
            hidden = level["virtual"]
            level["open"] |= hidden
            level["childless"][hidden] = 0
            level["leaves"], level["children"] = level["childless"].copy(), np.zeros(len(at), np.int64)
            level["saved"] = (n - 1) * level["size"]
            if d:
                level["parent"] = np.searchsorted(out[-1]["row"], at, side="right") - 1
            out.append(level)
        for above, level in zip(out[-2::-1], out[:0:-1]):
            for name in ("leaves", "saved"):
                np.add.at(above[name], level["parent"], level[name])
            above["children"] = np.bincount(level["parent"], minlength=len(above["row"]))
        return out

    def nodes(self) -> Iterator[list[list]]:
        """Columns of ``PART`` for the nodes of each depth."""
        state: dict[int, tuple] = {}  # of the open nodes one level up: hash so far, keys from the band's first node
        levels = self.levels()
        for d, level in enumerate(levels):
            now, key, above, path, ends, digest = {}, [], [], [], [], []
            before = levels[d - 1] if d else None
            last = np.append(level["begin"][1:], len(level["rows"]))
            ids = self.conv[level["rows"]]
            parents = level["parent"].tolist() if d else []
            for j, (row, opened, ending) in enumerate(zip(level["row"].tolist(), level["open"].tolist(), level["ends"].tolist())):
                above.append(state[parents[j]][1][-1] if d and parents[j] in state else None)
                if opened:
                    if d:
                        so_far, keys = state[parents[j]]
                        so_far = so_far.copy()
                        at = 16 * (int(self.first[row]) + d - 1)
                        so_far.update(self.flat[at:at + 16])
                        now[j] = so_far, [*keys, _key(_prefix(int(self.p1[row]), int(self.p2[row])), so_far)]
                    else:
                        now[j] = hashlib.md5(b"%d:" % self.band[row]), [_prefix(int(self.p1[row]), int(self.p2[row])).to_bytes(16, "big")]
                key.append(now[j][1][-1] if opened else None)
                path.append(now[j][1] if opened else None)
                found = []
                if ending:
                    part = slice(level["begin"][j], last[j])
                    found = ids[part][level["ending"][part]].tolist()
                ends.append(found if opened else None)
                digest.append(None if opened else hashlib.sha256(",".join(map(str, found)).encode()).hexdigest() if found else NONE)
            state = now
            yield [
                (self.band[level["row"]] * self.band_turns + d).tolist(), key, above, path, level["open"].tolist(), level["virtual"].tolist(),
                level["low"].tolist(), before["low"][level["parent"]].tolist() if d else [None] * len(key),
                *[level[x].tolist() for x in ("n", "size", "children", "leaves", "saved", "childless")], ends, digest,
            ]


def _parts(chunks: DataFrame, band_turns: int, shard_rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b for b in batches if b.num_rows]
        if read:
            for columns in Shard(pa.Table.from_batches(read), band_turns).nodes():
                for i in range(0, len(columns[0]), 50_000):
                    arrays = [pa.array(c[i:i + 50_000], t) for c, t in zip(columns, _KINDS)]
                    yield pa.RecordBatch.from_arrays(arrays, names=_NAMES)

    shards = max(1, -(-chunks.count() // shard_rows))
    return chunks.repartitionByRange(shards, "band", "p1", "p2", "keys", "conv_id").mapInArrow(run, PART)


def _chained(parts: DataFrame) -> DataFrame:
    """Checksum of the ascending member ids that end at each open node; its parts hold ascending stretches of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []
        names = ["key", "ends_sha256"]
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key != now:
                    if state is not None:
                        rows.append((now, state.hexdigest()))
                    now, state = key, None
                text = ",".join(map(str, ids.as_py()))
                if state is None:
                    state = hashlib.sha256()
                else:
                    text = f",{text}"
                state.update(text.encode())
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string()))], names=names)
                rows = []
        if state is not None:
            rows.append((now, state.hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string()))], names=names)

    ended = parts.where("open AND NOT virtual AND size(ends) > 0").select("key", "ends")
    return ended.repartition("key").sortWithinPartitions("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def _deeper(chunks: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of the groups of deeper bands, for each node above them: ``key``, ``leaves``, ``saved``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                path = path_keys(r["band"], r["p1"], r["p2"], r["keys"])
                rows += [(key, r["leaves"], r["saved"]) for key in path[1 if r["band"] else 0:]]
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "leaves", "saved"])

    # Each group's sums go to one of its conversations; those of all deeper bands are summed along that conversation.
    below = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    long = chunks.where("more OR band > 0").select("conv_id", "band").join(groups, ["conv_id", "band"], "left")
    sums = long.select("conv_id", "band", *[F.sum(c).over(below).alias(c) for c in ("leaves", "saved")])
    sums = sums.fillna(0, ["leaves", "saved"]).where("leaves != 0 OR saved != 0")
    return sums.join(chunks.select("conv_id", "band", "p1", "p2", "keys"), ["conv_id", "band"]).mapInArrow(
        run, "key binary, leaves bigint, saved bigint"
    )


def prefix_trie(turns: DataFrame, members: DataFrame | None = None, *, band_turns: int = 32, shard_rows: int = 100_000) -> DataFrame:
    """One row per node.

    ``turns`` has the columns that ``numbered_turns`` gives, with places from 0 without gaps; ``members`` may name further conversations
    that have no turns. ``conv_id`` is the node's smallest member, ``parent_conv_id`` its parent's, ``saved_tokens`` the bytes that
    members of the subtree need not hold again.
    """
    chunks = stored(chunks_of(turns, members, band_turns), "trie-shards")
    parts = stored(_parts(chunks, band_turns, shard_rows), "trie-parts")
    opened = parts.where("open").groupBy("key", "virtual").agg(
        F.min("depth").alias("depth"), F.min("above").alias("above"), F.min("path").alias("path"), F.min("low").alias("low"),
        F.max("size").alias("size"), F.count("*").alias("k"), F.min("childless").alias("childless"), F.sum("childless").alias("counted"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    opened = stored(opened, "trie-open")
    fixes = opened.where("k > 1 AND NOT virtual").select(
        (F.col("childless") - F.col("counted")).alias("leaves"), ((F.col("k") - 1) * F.col("size")).alias("saved"), "k",
        "depth", F.size("path").alias("n"), F.posexplode("path").alias("at", "key"),
    ).selectExpr(
        "key", f"at = 0 AND depth > {band_turns} AS virtual", "leaves", "saved", "IF(at = n - 2, 1 - k, 0) AS children",
    )
    fixes = fixes.groupBy("key", "virtual").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "children")])
    fixes = stored(fixes, "trie-fixes")
    groups = opened.where("virtual").select("key", F.col("low").alias("conv_id"), "depth", "n_leaves", F.col("saved").alias("own"), "n_children")
    groups = groups.join(fixes.where("virtual").drop("virtual"), "key", "left").selectExpr(
        "key", "conv_id", f"depth div {band_turns} AS band", "n_leaves + coalesce(leaves, 0) AS leaves",
        "own + coalesce(saved, 0) AS saved", "n_children + coalesce(children, 0) AS children",
    )
    more = _deeper(chunks, groups.select("conv_id", "band", "leaves", "saved")).select("key", "leaves", "saved", F.lit(0).cast("bigint").alias("children"))
    added = fixes.where("NOT virtual").select("key", "leaves", "saved", "children").unionByName(more).unionByName(
        groups.select("key", F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"), "children")
    )
    added = added.groupBy("key").agg(*[F.sum(c).alias(f"more_{c}") for c in ("leaves", "saved", "children")])
    whole = opened.where("NOT virtual").join(added, "key", "left").join(_chained(parts), "key", "left").select(
        "key", "above", "low", "depth", "n_convs",
        *[(F.col(a) + F.coalesce(f"more_{b}", F.lit(0))).alias(c) for a, b, c in (
            ("n_children", "children", "n_children"), ("n_leaves", "leaves", "n_leaves"), ("saved", "saved", "saved_tokens"))],
        F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"),
    )
    whole = stored(whole, "trie-whole")
    parents = whole.select(F.col("key").alias("above"), F.col("low").alias("found_low"))
    closed = parts.where("NOT open").select(
        "above", "low", "parent_low", "depth", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
    shown = ("depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    inner = closed.where("above IS NULL").select(F.col("low").alias("conv_id"), F.col("parent_low").alias("parent_conv_id"), *shown)
    edge = closed.where("above IS NOT NULL").drop("parent_low").unionByName(whole.drop("key"))
    edge = edge.join(parents, "above", "left").select(F.col("low").alias("conv_id"), F.col("found_low").alias("parent_conv_id"), *shown)
    return inner.unionByName(edge).select("conv_id", "depth", "parent_conv_id", *shown[1:])
