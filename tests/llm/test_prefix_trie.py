"""Prefix tries against brute force, in bands and shards of any size."""

import hashlib
import random
import zlib

import pytest

from tablewright.llm.op13_query import rebuilt
from tablewright.llm.prefix_trie import numbered_turns, prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(convs):
    """Every prefix of every conversation; ``convs`` maps ids to tuples of (role, text)."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    below = {p: [q for q in members if q[:len(p)] == p] for p in members}
    out = []
    for p, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(p))
        leaves = [q for q in below[p] if not any(len(x) > len(q) for x in below[q])]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below[p] if q)
        out.append((
            min(who), len(p), min(members[p[:-1]]) if p else None, len(who), sum(len(q) == len(p) + 1 for q in below[p]), len(leaves), saved,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def grouped(rows):
    out = {}
    for key, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if key is not None:
            out.setdefault(key, []).append((role or "", text or ""))
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    assert df.columns == list(COLUMNS) and {t for c, t in df.dtypes if c != "ends_sha256"} == {"bigint"}
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def made(seed, n):
    """Conversations that share beginnings of all lengths, with copies, ties, nulls and repeated rows."""
    rng, rows = random.Random(seed), []
    whole = {}
    for c in range(n):
        old = rng.choice(list(whole.values())) if whole and rng.random() < 0.8 else []
        turns = list(old[:rng.randint(0, len(old))]) if rng.random() < 0.7 else list(old)
        turns += [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "é", "long " * 9])) for _ in range(rng.randint(0, 3))]
        whole[c] = turns or [("user", "x")]
    for c, turns in whole.items():
        rows += [(c * 3 - 20, None if t == 0 and c % 4 else t, r, x) for t, (r, x) in enumerate(turns)]
    rows += [(100 * n, 0, "user", "tie"), (100 * n, 0, "user", "a"), (100 * n, 0, "user", "a"), (None, 0, "user", "lost")]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, pos int, key string"


@pytest.mark.parametrize("seed,band,shard", [(1, 32, 100_000), (2, 32, 7), (3, 2, 100_000), (4, 2, 5), (5, 1, 3), (6, 3, 1)])
def test_trie_matches_brute_force(spark, seed, band, shard):
    rows = made(seed, 60)
    table = spark.createDataFrame([r + (1, "x") for r in rows], SCHEMA).repartition(3)
    assert found(prefix_trie(numbered_turns(table), band_turns=band, shard_rows=shard)) == brute(grouped(rows))


@pytest.mark.parametrize("band,shard", [(4, 11), (32, 100_000)])
def test_alike_and_very_long_conversations(spark, band, shard):
    """A hot conversation in many copies, two long ones that part late, and members without turns."""
    rows = [(c, t, "user", f"{t}") for c in range(50) for t in range(6)]
    rows += [(c, t, "user", f"{t % 7}" if t < 90 + c - 200 else f"{c} {t}") for c in (200, 203, 209) for t in range(120)]
    table = spark.createDataFrame([r + (1, "x") for r in rows], SCHEMA)
    idle = spark.createDataFrame([(7,), (900,), (901,), (901,)], "conv_id long")
    want = brute(grouped(rows) | {900: (), 901: ()})
    assert found(prefix_trie(numbered_turns(table), idle, band_turns=band, shard_rows=shard)) == want


@pytest.mark.parametrize("seed", [7, 8])
def test_rebuilt_conversations(spark, seed):
    rows = made(seed, 70)
    turns = numbered_turns(spark.createDataFrame([r + (1, "x") for r in rows], SCHEMA))
    members = turns.select("conv_id").distinct()
    said, want = grouped(rows), {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        want[c] = said.get(base, ())[:h] + own[h:]
    assert found(prefix_trie(rebuilt(turns, members), members, band_turns=3, shard_rows=9)) == brute(want)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(numbered_turns(none)).collect() == []
    nobody = spark.createDataFrame([(None, 0, "user", "x", 1, "x")], SCHEMA)
    assert prefix_trie(numbered_turns(nobody)).collect() == []
