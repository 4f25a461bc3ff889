"""Periodic runs against brute force over all lags, and the cases the docstring defines."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tablewright.llm.op11_query import op11_periodic_runs, with_tail
from tablewright.llm.periodic_runs import find_runs, first_gram, greatest, periodic_runs


def brute(words, least, periods):
    """Every lag, every stretch; a stretch met before at a smaller lag has a smaller period."""
    out, met = [], set()
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q) and (i, j) not in met:
                if not any(s == i and s + n == j + q for s, n, _ in out):
                    out.append((i, j + q - i, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(0, 140))]
    if words and rng.random() < 0.7:
        start, q = rng.randrange(len(words)), rng.randint(1, 40)
        words[start:] = [words[start + (i - start) % q] if start + (i - start) % q < len(words) else 7 for i in range(start, len(words))]
        if rng.random() < 0.4:
            words[rng.randrange(len(words))] = 99
    if rng.random() < 0.2:  # no word sequence of 16 stands at a distance of one period only
        shared = [rng.randrange(2) for _ in range(15)]
        words = ([*shared, 5] * 2 + [*shared, 6] * 2) * 4 + words
    return words


@pytest.mark.parametrize("least,periods", [(24, 3), (10, 3), (7, 4), (1, 3), (30, 5)])
def test_runs_match_brute_force(least, periods):
    rng = random.Random(least)
    for _ in range(300):
        texts = [made(rng) for _ in range(rng.randint(1, 4))]
        found = find_runs([np.array(x, np.int64) for x in texts], least, periods)
        assert found == [brute(x, least, periods) for x in texts]


def test_first_grams_are_the_least_overlap():
    assert first_gram(24, 3) == 16
    assert find_runs([], 24, 3) == []


def test_greatest_is_exact_and_first():
    assert greatest([(0, 30, 10), (40, 27, 9), (80, 24, 8)]) == (0, 30, 10)
    big = 10**17
    assert greatest([(0, 3 * big, big), (9, 3 * big + 1, big)]) == (9, 3 * big + 1, big)
    assert greatest([]) is None


EDGES = {
    1: None, 2: "", 3: " \n\t ", 4: "a " * 23, 5: "a " * 24, 6: ("x y\tz\n" * 9).strip(), 7: "la " * 100_000,
    8: "pre " + "b c d e f g h i j k " * 3 + "post", 9: "ünï cödé " * 12, 10: " ".join(f"w{i}" for i in range(3000)),
}


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(k, v, "x", 1) for k, v in EDGES.items()] + [(6, EDGES[6], "x", 1), (None, "q " * 30, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")


def test_edges(edges):
    rows = periodic_runs(edges, lot_words=500).collect()
    assert len(rows) == len(EDGES) + 2
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in rows}
    assert got[1] == got[2] == got[3] == got[4] == got[10] == []
    assert got[5] == [(0, 24, 1)] and got[6] == [(0, 27, 3)] and got[7] == [(0, 100_000, 1)]
    assert got[8] == [(1, 30, 10)] and got[9] == [(0, 24, 2)] and got[None] == [(0, 30, 1)]
    kept = {r["doc_id"]: r["collapsed"] for r in rows}
    assert kept[7] == "la" and kept[6] == "x y z" and kept[8] == "pre b c d e f g h i j k post"
    assert kept[1] == kept[3] == "" and kept[10] == EDGES[10]
    assert {r["best"] for r in rows if r["doc_id"] in (1, 4)} == {None}


def test_empty_table_and_bad_limits(spark, edges):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(edges, least_periods=2)


def test_tail_keeps_the_number_of_words():
    assert with_tail(None, [b"a"]) == [b"a"]
    for key in range(400):
        words = [str(i).encode() for i in range(key % 90)]
        out = with_tail(key, words)
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            assert out == [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        else:
            assert out is words


def test_query_matches_brute_force(spark, data):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = op11_periodic_runs(spark, data).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    checked = 0
    for r in rows:
        words = with_tail(r["doc_id"], (texts[r["doc_id"]] or "").encode().split())
        if len(words) > 1200:
            continue
        checked += 1
        runs = brute(words, 24, 3)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        best = greatest(runs)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
    assert checked > 150
