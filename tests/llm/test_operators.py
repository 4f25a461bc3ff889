"""Operators against brute force, and the edge cases their docstrings define."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import suffix_sorting
from tablewright.llm.license_scans import scan_licenses
from tablewright.llm.minhash_tensor import near_duplicates
from tablewright.llm.mixing import fit_distributed, fit_in_memory, mix, reached
from tablewright.llm.packing import assign, capacities, pack
from tablewright.llm.quality_lines import kept_only, quality_rules
from tablewright.llm.secret_scans import redacted, scan_secrets
from tablewright.llm.sharding import shard
from tablewright.llm.suffix_dedup import marks, remove_repeats
from tablewright.llm.suffix_sorting import common_prefixes, suffix_array
from tablewright.llm.topk_pivots import integer_vectors, top_k
from tablewright.llm.toxicity import SIZE, decode, score_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept int, spans string"
LONG = " ".join(f"word{i}" for i in range(3000)) + "."


def frame(spark, texts, sources=None):
    """Rows with nulls, clashing extra columns and the given texts."""
    rows = [(i, t, "en" if i % 2 else None, sources[i] if sources else f"s{i % 3}", None, 7, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


EDGES = [None, "", " \n\t ", "one", LONG, LONG, "Same words. " * 30, "ünïcode   blank", "a" * 2000]


@pytest.fixture(scope="module")
def edges(spark):
    return frame(spark, EDGES).union(frame(spark, EDGES[:5])).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(texts, k):
    sets = [shingles(t, k) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return [(len(s), x) for s, x in zip(sets, label)]


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choice(words, rng.integers(2, 90)).tolist()
        for _ in range(rng.integers(1, 12)):
            now = list(base)
            for _ in range(rng.integers(0, 4)):
                now[rng.integers(len(now))] = str(rng.choice(words))
            texts.append(" ".join(now))
    texts += ["Alone", "alone", "", None]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame(spark, texts), shingle=2).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts, 2)


def test_near_duplicates_edges(spark, edges, empty):
    got = near_duplicates(edges, shingle=2)
    rows = got.collect()
    assert len(rows) == len(EDGES) + 5
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5)} == {4}
    assert all(r["kept"] for r in rows if r["doc_id"] in (0, 1, 2))
    assert near_duplicates(empty).count() == 0


def brute_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(x[s:s + length] for x in data for s in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = [False] * len(x)
        for s in range(len(x) - length + 1):
            if seen[x[s:s + length]] > 1:
                gone[s:s + length] = [True] * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("mark_bytes", [32_000_000, 500])
def test_repeats_match_brute_force(spark, mark_bytes):
    rng = np.random.default_rng(4)
    passage = "".join(rng.choice(list("abcdef "), 400))
    texts = [None, "", "short", "ab" * 300, "x" * 450, passage, passage, "é" * 150 + passage[50:290]]
    for i in range(30):
        own = "".join(rng.choice(list("abcdefghij "), rng.integers(0, 300)))
        at = int(rng.integers(0, 200))
        texts.append(own + passage[at:at + int(rng.integers(150, 400))] + own[::-1])
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["kept"])
           for r in remove_repeats(frame(spark, texts), mark_bytes=mark_bytes).collect()}
    assert [got[i][:4] for i in range(len(texts))] == brute_removed(texts, 200)
    assert all(hashlib.sha256(bytes(v[4])).hexdigest() == v[3] for v in got.values())


def test_repeats_edges(edges, empty):
    rows = remove_repeats(edges, with_text=False).collect()
    assert len(rows) == len(EDGES) + 5
    assert all(r["n_removed"] == r["n_bytes"] for r in rows if r["doc_id"] in (4, 5))
    assert remove_repeats(empty).count() == 0


def test_repeats_of_a_very_common_passage(spark):
    """One mark in more contexts than a shard may hold: they are dealt again by the bytes around it, down to whole windows."""
    rng = np.random.default_rng(9)
    passage = "".join(rng.choice(list("abcdefghij "), 210))
    texts = ["".join(rng.choice(list("klmnop "), 150)) + passage + "".join(rng.choice(list("qrstuv "), 150)) for _ in range(60)]
    texts += [passage[:199], passage[:200], passage[5:205], texts[0], texts[0]]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in remove_repeats(frame(spark, texts), mark_bytes=300, with_text=False).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, 200)


def test_suffix_sorting():
    rng = np.random.default_rng(1)
    for n, letters in [(1, 1), (2, 1), (50, 1), (200, 2), (300, 3), (3000, 2), (5000, 200)]:
        t = rng.integers(0, letters, n)
        t = np.r_[t, t[:n // 2]]
        sa = suffix_array(t, letters)
        values = t.tolist()
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: values[i:])
        before, shared = common_prefixes(t, sa, np.array([0]), 10 ** 6)
        for i, j in list(zip(sa[1:].tolist(), sa[:-1].tolist()))[:200]:
            k = 0
            while max(i, j) + k < len(t) and values[i + k] == values[j + k]:
                k += 1
            assert (before[i], shared[i]) == (j, k)


def test_marks_of_texts_read_as_one():
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 97 + letters, n).astype(np.uint8)) for letters, n in [(2, 50), (1, 90), (26, 400), (3, 51), (26, 50), (4, 300)]]
    got = list(zip(*(c.tolist() for c in marks(texts, 50, 16))))
    alone = [(i, *row[1:]) for i, t in enumerate(texts) for row in zip(*(c.tolist() for c in marks([t], 50, 16)))]
    assert got == alone
    for i, t in enumerate(texts):
        runs = [(s, n) for text, _, s, n, _ in got if text == i]
        assert [w for s, n in runs for w in range(s, s + n)] == list(range(len(t) - 49))
    grams = {}
    for i, mark, s, n, p in got:
        assert s + n - 1 <= s + p <= s + 34  # the mark's string lies in each window of the run
        assert grams.setdefault(mark, texts[i][s + p:s + p + 16]) == texts[i][s + p:s + p + 16]


def test_repeats_seen_by_one_task_or_by_several(spark):
    """Marks that are frequent in a task, seen once in each of several, and both; the texts are marked once."""
    rng = np.random.default_rng(12)
    passages = ["".join(rng.choice(list("abcdefghij "), 260)) for _ in range(3)]
    own = ["".join(rng.choice(list("klmnopqrst "), 300)) for _ in range(24)]
    texts = [own[i] + passages[0] * (i in (0, 1)) + passages[1] * (i % 8 == 0) + passages[2] * (i in (2, 3, 20)) + own[i][:99] for i in range(24)]
    texts += [own[7] + own[8], texts[5], None, ""]
    df = frame(spark, texts)
    result = remove_repeats(df.repartitionByRange(4, "doc_id"), with_text=False)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in result.collect()}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, 200)


def test_suffix_sorting_takes_two_rounds(monkeypatch):
    """Repeated names are told apart by doubling; they were sorted by recursion, in ever more and shorter stretches."""
    calls, induce = [], suffix_sorting._induce
    monkeypatch.setattr(suffix_sorting, "_induce", lambda *a: calls.append(len(a[0])) or induce(*a))
    rng = np.random.default_rng(2)
    part = rng.integers(1, 5, 300)
    t = np.concatenate([np.r_[part[int(rng.integers(0, 90)):], 0] for _ in range(40)])
    sa = suffix_sorting.suffix_array(t, 5)
    values = t.tolist()
    assert sa.tolist() == sorted(range(len(t)), key=lambda i: values[i:])
    assert calls == [len(t)] * 2
    order = np.argsort([3, 1, 1, 2, 1, 1, 2], kind="stable")
    name = np.array([3, 1, 1, 2, 1, 1, 2])[order]
    assert suffix_sorting._by_names(order, np.r_[False, name[1:] == name[:-1]]).tolist() == [4, 1, 5, 2, 6, 3, 0]


def test_packing_round_trip(spark, edges, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = pack(edges, length=64, lot_sequences=8).collect()
    want = Counter((r["doc_id"], bytes(np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()))
                   for r in edges.collect())
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by_doc.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    whole = Counter()
    for doc, parts in by_doc.items():
        copies = sum(n for (d, _), n in want.items() if d == doc)
        starts = {}
        for start, ids in sorted(parts):
            starts.setdefault(start, []).append(ids)
        assert sum(len(p[1]) for p in parts) == sum(len(ids) * n for (d, ids), n in want.items() if d == doc)
        if copies == 1:
            whole[(doc, b"".join(ids for _, ids in sorted(parts)))] += 1
    assert all(want[key] == n for key, n in whole.items())
    for parts in by_sequence.values():
        size = 0
        for offset, n in sorted(parts):
            assert offset == size
            size += n
        assert size == 64 or size & (size - 1) == 0
    assert pack(empty).count() == 0


@pytest.mark.parametrize("most", [40, 10 ** 6])
def test_word_table_gives_the_tokenizer_ids(most):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tablewright.llm.packing import WordIds

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, ids = Tokenizer.from_file(path), WordIds(path, most)
    rng = np.random.default_rng(0)
    marks = list("aZéÉßΣσİıK²½.,!?'-_ \n\t\u00a0\u0301\u0307\u1c9fあ漢🙂<|>") + ["It's", "WORD.", "end,", "<|endoftext|>", " 'S ", "x.."]
    for _ in range(300):
        text = "".join(rng.choice(marks, rng.integers(0, 60)))
        assert ids(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_packing_cuts_and_balance():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 90, 200).tolist() + [700, 1]
    room = capacities(sum(sizes), 64)
    filled = assign(sizes, room, 1.0, 1 / 64)
    assert [sum(p[2] for p in pieces) for pieces in filled] == room
    for doc, size in enumerate(sizes):
        parts = sorted((s, n) for pieces in filled for d, s, n in pieces if d == doc)
        assert sum(n for _, n in parts) == size and all(parts[i][0] == sum(n for _, n in parts[:i]) for i in range(len(parts)))


@pytest.mark.parametrize("n,k", [(0, 5), (3, 5), (400, 5)])
def test_top_k_matches_brute_force(spark, n, k):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, 6)), 1)
    if n > 100:
        x[50:180] = x[50]  # a third of all vectors are equal
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(10 ** 6, None), (10 ** 6 + 1, [1.0, None]), (10 ** 6 + 2, [float("nan")])]
    points = integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 64)
    got = {}
    for r in top_k(points, points.where("id % 20 = 0"), k, pivots=4, sample=40, ring_rows=16, query_rows=4, lanes=2).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    v = np.floor(64 * x).astype(np.int64)
    want = {}
    for q in range(0, n, 20):
        best = sorted((-int(v[q] @ v[i]), i) for i in range(n) if i != q)[:k]
        want[q] = [(rank, *b) for rank, b in enumerate(best, 1)]
    assert {q: sorted(r) for q, r in got.items()} == want


def test_top_k_ranks_per_query_row(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, size=(60, 4)).astype(float)
    x[7, 0] = 40000  # needs wider integers
    ids = [i % 40 for i in range(60)]  # ids 0 to 19 are held twice, by different vectors
    points = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)] + [(20, x[20].tolist())], "id long, vec array<double>")
    got = Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(
        points, points.where("id % 20 = 0"), 7, pivots=3, sample=20, ring_rows=8, query_rows=2, lanes=2).collect())
    ids, x = [*ids, 20], np.vstack([x, x[20]])
    want = Counter()
    for q in range(61):
        if ids[q] % 20 == 0:
            best = sorted((-int(x[q] @ x[i]), ids[i]) for i in range(61) if ids[i] != ids[q])[:7]
            want.update((ids[q], rank, i, -s) for rank, (s, i) in enumerate(best, 1))
    assert got == want


def test_quality_rules_edges(edges, empty):
    rows = quality_rules(edges).select("doc_id", "kept", "quality").collect()
    by_id = {r["doc_id"]: r["quality"] for r in rows}
    assert not any(by_id[i]["kept"] for i in (0, 1, 2, 3, 6)) and by_id[4]["kept"]
    assert by_id[0]["n_words"] == 0 and by_id[0]["base_failed"] and by_id[4]["text"] == LONG
    assert {r["kept"] for r in rows} == {7}
    assert kept_only(quality_rules(edges)).count() == sum(r["quality"]["kept"] for r in rows)
    assert quality_rules(empty).count() == 0


def test_quality_rules_drop_lines(spark):
    other = "Here stands another sentence of the same kind, made of quite different words, as a text should have."
    good = "This is a line of plain prose that ends as it should, with some words in it."
    text = "\n".join([good, "Home | News | Contact | Login", "Menu", "All rights reserved.", other])
    row = quality_rules(frame(spark, [text])).select("quality.*").first()
    assert row["text"].split("\n") == [good, other] and row["kept"]
    assert row["n_lines_removed"] == 3


def test_quality_rules_judge_a_line_alike_in_every_text(spark):
    good = "This is a line of plain prose that ends as it should, with some words in it."
    more = "Here stands another sentence of the same kind, made of quite different words, as texts have."
    texts = [f"{good}\n{line}\n{more}" for line in ("Wow! no no no", "Wow! Wow! no no", "Wow! Wow! Wow! x y y")]
    texts += [t + " Very very good." for t in texts]
    rows = [(i, t, "mine") for i, t in enumerate(texts)]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, __q_words string"))
    assert out.columns == ["doc_id", "text", "__q_words", "quality"]
    assert all(r["__q_words"] == "mine" and "Wow" not in r["quality"]["text"] and r["quality"]["kept"] for r in out.collect())
    assert kept_only(out).columns == out.columns


def test_secrets(spark, empty):
    live, shared = "k9Qz7Lm2Xw8Rt4Vb", "aB3dE5gH7jK9mN1p"
    texts = [f"é password = '{live}' end", f"token:{shared}", f"x token:{shared}", f"TOKEN={shared}", None, "", "api_key=short",
             "AKIA" + "Z" * 16 + " " + "0123456789abcdef" * 2, "blob Zx81kq0PvW93hd7Rty5Lm2 end"]
    found = {r["doc_id"]: r["spans"] for r in scan_secrets(frame(spark, texts, [f"o{i}" for i in range(len(texts))])).collect()}
    assert [(s["kind"], s["start"], s["end"], s["verdict"]) for s in found[0]] == [("assign", 2, 30, "live")]
    assert {s["verdict"] for i in (1, 2, 3) for s in found[i]} == {"example"}
    assert found[4] == found[5] == found[6] == []
    assert [s["kind"] for s in found[7]] == ["access", "hex"]
    assert [(s["kind"], s["start"]) for s in found[8]] == [("live", 5)]
    out = {r["doc_id"]: r for r in redacted(frame(spark, texts, [f"o{i}" for i in range(len(texts))])).collect()}
    assert live not in out[0]["text"] and shared in out[1]["text"] and out[4]["text"] is None and out[0]["spans"] == "x"
    assert scan_secrets(empty).count() == 0


def test_secrets_in_many_repositories_of_one_owner_are_examples(spark):
    copied, own = "Zk3Qw9Lm2Xc7Vb5Nt8Rp", "Hy6Tg1Fd4Sa0Jk8Lz2Qe"
    rows = [(i, f"key {copied} end", f"l{i % 4}", "hot", None, 7, "x") for i in range(40)]
    rows += [(100 + i, f"key {own} end", f"l{i % 3}", "hot", None, 7, "x") for i in range(9)]
    docs = spark.createDataFrame(rows, DOCS)
    out = {r["doc_id"]: r["text"] for r in redacted(docs).collect()}
    assert all(copied in out[i] for i in range(40)) and not any(own in out[100 + i] for i in range(9))


def test_licenses(spark, edges, empty):
    texts = ["Released under the\nMIT License.\nmore", "The General Public License and the apache license", None, "", "all rights\nare reserved", "All Rights Reserved"]
    got = {r["doc_id"]: r for r in scan_licenses(frame(spark, texts)).collect()}
    assert got[0]["base_labels"] == ["mit"] and got[0]["template_labels"] == ["mit-notice"] and got[0]["first_word"] == 3
    assert got[1]["base_labels"] == ["apache", "gpl"] and (got[1]["first_word"], got[1]["last_word"], got[1]["n_base"]) == (1, 6, 2)
    assert got[2]["n_words"] == got[3]["n_words"] == 0 and got[2]["first_word"] is None
    assert got[4]["template_labels"] == ["reserved"] == got[5]["template_labels"]
    assert scan_licenses(edges).count() == len(EDGES) + 5 and scan_licenses(empty).count() == 0


def test_licenses_are_found_however_they_are_wrapped(spark):
    import textwrap

    from tablewright.llm.license_scans import TEMPLATES, WHOLE

    whole = {"long": " ".join(f"term{i}" for i in range(120))}
    cases = [(label, width, gap) for label in ("mit-grant", "bsd-terms", *WHOLE) for width in (32, 60) for gap in ("\n", "\n\n")]
    texts = ["Some words before.\n" * 7 + gap.join("# " + x for x in textwrap.wrap((TEMPLATES | WHOLE)[label], width)) + "\nmore" * 9 for label, width, gap in cases]
    got = {r["doc_id"]: r for r in scan_licenses(frame(spark, [*texts, "term words of the license " * 30])).collect()}
    assert all(label in got[i]["template_labels"] and got[i]["containment"] == 1.0 for i, (label, _, _) in enumerate(cases))
    assert got[len(cases)]["template_labels"] == []
    wrapped = "\n\n".join(textwrap.wrap(whole["long"], 30))
    assert scan_licenses(frame(spark, ["x " * 50 + wrapped]), templates=whole).first()["template_labels"] == ["long"]


def test_shards(spark, edges, empty):
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(2000)] + [(5, "y" * 30)] * 40 + [(None, None)], "doc_id long, text string")
    rows = shard(docs, limit=300).collect()
    held = Counter()
    for r in rows:
        held[r["shard"]] += len(r["text"] or "")
    assert len(rows) == 2041 and max(held.values()) <= 300 and all(held[r["shard"]] == r["shard_bytes"] for r in rows)
    bits = {r["shard"].split(".")[0] for r in rows}
    assert not any(a != b and a.startswith(b) for a in bits for b in bits)
    assert shard(edges, limit=10 ** 9).select("shard").distinct().count() == 1 and shard(empty).count() == 0


def test_shards_of_a_hot_key(spark):
    """Rows of one key fill their parts, a row above the limit stands alone, columns of the input keep their names."""
    rows = [(7, "z" * 10, i) for i in range(1000)] + [(7, "z" * 400, -1), (7, "z" * 500, -2)] + [(i, "x" * 9, i) for i in range(50, 550)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __h long").repartition(5)
    out = shard(docs, limit=300)
    assert out.columns == ["doc_id", "text", "__h", "shard_depth", "shard_part", "shard_bytes", "shard"]
    got = out.collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(rows)
    held = Counter()
    for r in got:
        held[r["shard"]] += len(r["text"])
    assert all(held[r["shard"]] == r["shard_bytes"] for r in got)
    assert sorted(r["__h"] for r in got if held[r["shard"]] > 300) == [-2, -1]
    assert all(r["shard_part"] < 0 for r in got if r["__h"] < 0)
    parts = {r["shard"] for r in got if r["doc_id"] == 7 and r["__h"] >= 0}
    assert 1000 * 10 / 300 <= len(parts) <= 3 * 1000 * 10 / 300
    one = shard(spark.createDataFrame([(1, "a" * 10)] * 50 + [(1, "a" * 101)], "doc_id long, text string"), limit=100)
    assert one.select("shard").distinct().count() <= 12


def test_shard_names_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a", "old", 3)], "doc_id long, text string, Shard string, `a.b` int")
    row = shard(docs, limit=10).first()
    assert row["shard"] == "" and row["a.b"] == 3 and row["shard_bytes"] == 1


def test_mixing(spark, edges, empty):
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(rng.integers(1, 40)), "a" if i % 3 else "b", f"s{min(int(rng.geometric(0.3)), 5)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"m_lang": {"a": 0.5, "b": 0.5, "none": 0.3}}
    out = mix(docs, targets=targets, budget_share=0.5).collect()
    total = sum(r["n_tokens"] for r in out)
    share = sum(r["n_tokens"] * r["weight"] for r in out if r["lang"] == "a") / total
    assert abs(share - 0.5) < 1e-6
    assert abs(sum(r["n_tokens"] * r["probability"] for r in out) / total - 0.5) < 1e-6
    assert abs(sum(r["n_tokens"] for r in out if r["sampled"]) / total - 0.5) < 0.05
    assert mix(edges).count() == len(EDGES) + 5 and mix(empty).count() == 0


def test_mixing_meets_targets_at_probability_one(spark):
    """The sample itself has the target shares, with values that are too rare for the budget; names of the input stay."""
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 40)), "a" if i % 20 else "b", f"s{i % 3}", 1, "kept", None) for i in range(4000)] + [(7, None, None, None, 1, "kept", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, weight long, m_source string, `a.b` int")
    targets = {"m_lang": {"a": 0.8, "b": 0.2}, "m_source": {"s0": 0.5, "s1": 0.25, "s2": 0.25}}
    mixed = mix(docs, targets=targets, budget_share=0.8).cache()
    assert mixed.columns == ["doc_id", "text", "lang", "source", "m_source", "a.b", "n_tokens", "weight", "probability", "sampled"]
    assert {r["m_source"] for r in mixed.collect()} == {"kept"} and mixed.count() == len(rows)
    shares = {(r["margin"], r["value"]): r for r in reached(mixed, lang=mixed["lang"], source=mixed["source"]).collect()}
    for key, goal in [(("lang", "a"), 0.8), (("lang", "b"), 0.2), (("source", "s0"), 0.5), (("source", "s1"), 0.25)]:
        assert shares[key]["expected"] == pytest.approx(goal, abs=1e-5) and shares[key]["sampled"] == pytest.approx(goal, abs=0.04)
    assert max(r["probability"] for r in mixed.where("n_tokens > 0").collect()) > 0.98  # as large a sample as the targets allow


def test_mixing_is_the_same_in_both_forms(spark):
    cells = [("s1", "a", "x", 50), ("s1", "b", "x", 10), ("s2", "a", "y", 30), ("s3", "b", "y", 0), ("s2", "b", "x", 25)]
    df = spark.createDataFrame(cells, "m_source string, m_lang string, m_topic string, tokens long")
    options = ({"m_lang": {"a": 0.5, "b": 0.5}}, 0.9, 4, 1e-2, 0.95, 1)
    w, p = fit_in_memory(df.collect(), *options)
    other = {(r["m_source"], r["m_lang"], r["m_topic"]): (r["per_token"], r["probability"]) for r in fit_distributed(df, *options).collect()}
    for c, a, b in zip(df.collect(), w, p):
        assert other[tuple(c[:3])] == pytest.approx((a, b), rel=1e-6)


def test_toxicity(spark, edges, empty):
    rng = np.random.default_rng(0)
    words = ["river", "stone", "garden", "window", "letter", "music", "summer", "table"]
    texts = [" ".join(rng.choice(words, 12)) + (" you moron" if i % 4 == 0 else "") for i in range(400)]
    probes = ["you m0r0n there", "you m o r o n there", "mooooron", "garden stone", None, ""]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, None)], "doc_id long, label int")
    got = {r["doc_id"]: r["score"] for r in score_toxicity(frame(spark, texts + probes), labels).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(400))
    assert [got[400 + i] >= 0.5 for i in range(6)] == [True, True, True, False, False, False]
    none = labels.limit(0)
    assert all(0 <= r["score"] < 0.5 for r in score_toxicity(edges, none).collect())
    assert score_toxicity(empty, none).count() == 0


def test_decode_picks_the_likelier_word():
    from tablewright.llm.toxicity import PLACE

    costs = np.full((SIZE, SIZE, SIZE), 5.0)
    for a, b, c in zip("  idiot", " idiot ", "idiot  "):
        costs[PLACE[a], PLACE[b], PLACE[c]] = 0.1
    assert decode("1d!0t", costs) == "idiot" and decode("i.d-i o t", costs) == "idiot"


def test_long_obfuscations_are_decoded_whole(spark):
    from tablewright.llm.toxicity import SPACED

    flat = np.full((SIZE, SIZE, SIZE), 5.0)
    run = " ".join("moron" * 200)
    assert SPACED.findall(f"so {run} there") == [run] and len(decode(run, flat)) == 1000
    rng = np.random.default_rng(1)
    words = ["river", "stone", "garden", "window", "letter", "music", "summer", "table"]
    texts = [" ".join(rng.choice(words, 12)) + (" you moron" if i % 4 == 0 else "") for i in range(400)]
    probes = ["m" + "o" * 80 + "ron", "m" + "-_." * 30 + "oron", "m" + " ." * 150 + "o r o n", "r" + "i" * 80 + "ver", "_" * 3000 + "!"]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, label int")
    got = {r["doc_id"]: r["score"] for r in score_toxicity(frame(spark, texts + probes), labels).collect()}
    assert [got[400 + i] >= 0.5 for i in range(5)] == [True, True, True, False, False]


def test_spaced_runs_are_cut_into_words_and_other_scripts_restored(spark):
    rng = np.random.default_rng(2)
    words = ["river", "stone", "garden", "window", "letter", "music", "summer", "table", "you", "are", "i", "am", "a"]
    texts = [" ".join(rng.choice(words, 12)) + (" you are a moron" if i % 4 == 0 else "") for i in range(400)]
    spaced = " ".join("iamagardenyouareamoron")
    probes = [
        "you are a m o r o n ok", "i m o r o n you", "i am a m o r o n", "y o u a r e a m o r o n!", spaced, "y o u  a r e  a  m o r o n",
        "you-are-a-m-o-r-o-n", "m\u043er\u043en", "\uff4d\uff4f\uff52\uff4f\uff4e", "i a m a g a r d e n", "a r i v e r", "you are a garden",
    ]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, label int")
    got = {r["doc_id"]: r["score"] for r in score_toxicity(frame(spark, texts + probes), labels).collect()}
    assert [got[400 + i] >= 0.5 for i in range(len(probes))] == [True] * 9 + [False] * 3
    flat = np.full((SIZE, SIZE, SIZE), 5.0)
    assert decode("д-у-р-а-к", flat) == "дурак"


def test_long_known_words_are_cut_out_of_spaced_runs():
    from tablewright.llm.toxicity import by_beginning, segment

    flat = np.full((SIZE, SIZE, SIZE), 5.0)
    word = "donaudampfschifffahrtsgesellschaft"
    known = {word: 3.0, "you": 1.0, "are": 1.0}
    assert segment(f"youare{word}you", flat, known, by_beginning(known)) == ["you", "are", word, "you"]


def test_the_largest_of_conflicting_labels_holds(spark):
    texts = ["river stone" if i % 2 else "river moron" for i in range(60)]
    labels = [(i, int(i % 2 == 0)) for i in range(60)]
    both = spark.createDataFrame(labels + [(i, 0) for i in range(60)], "doc_id long, label int")
    want = score_toxicity(frame(spark, texts), spark.createDataFrame(labels, "doc_id long, label int")).collect()
    got = score_toxicity(frame(spark, texts), both).collect()
    assert {r["doc_id"]: round(r["score"], 9) for r in got} == {r["doc_id"]: round(r["score"], 9) for r in want}


def test_toxicity_learns_from_every_labelled_text(spark):
    """The toxic texts come after the first 20,000 labelled ids in the order of their hashes."""
    from pyspark.sql import functions as F

    rows = spark.range(20_400).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("t"))
    late = [r["doc_id"] for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").collect()[20_000:]]
    toxic = F.col("doc_id").isin(late[::2])
    docs = rows.select("doc_id", F.concat(F.lit("river stone "), "t", F.when(toxic, " you moron").otherwise("")).alias("text"))
    got = score_toxicity(docs, rows.select("doc_id", toxic.cast("int").alias("label")))
    assert {r["doc_id"] for r in got.where("score >= 0.5").collect()} == set(late[::2])


def test_toxicity_keeps_all_chosen_features(spark):
    """2,400 words of toxic texts, each in two of them; the last ones alone mark a text as well."""
    letters = "abcdefghijklmnop"
    words = sorted(a + "q" + b + c for a in letters for b in letters for c in letters)[:2_400]
    toxic = [" ".join(words[i % 2_400:i % 2_400 + 10]) + f" {i}" for i in range(0, 4_800, 10)]
    clean = [f"river stone {i}" for i in range(600)]
    probes = [" ".join(words[-10:]), "river stone"]
    docs = spark.createDataFrame(list(enumerate(toxic + clean + probes)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 480)) for i in range(1_080)], "doc_id long, label int")
    got = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels).collect()}
    assert got[1_080] >= 0.5 > got[1_081] and all((got[i] >= 0.5) == (i < 480) for i in range(1_080))


def test_all_known_words_cut_runs(spark):
    """Words beyond the 50,000th count, and those that stand in no run change nothing."""
    from pyspark.sql import functions as F
    from tablewright.llm.toxicity import by_beginning, known_words, segment

    flat = np.full((SIZE, SIZE, SIZE), 5.0)
    long = "donaudampfschifffahrtsgesellschaft"
    rare = [("you", 40), ("zebra", 2), (long, 3), ("zzz", 2), (long[:24] + "s", 2)]
    words = spark.range(60_000).select(F.concat(F.lit("w"), "id").alias("f"), F.lit(5).cast("long").alias("n")).union(
        spark.createDataFrame(rare, "f string, n long"))
    texts = ["youzebrayou", f"you{long}zebra"]
    known = known_words(words, spark.createDataFrame([(texts,), (texts[:1],)], "letters array<string>"), most=50)
    whole = {r["f"]: np.log((300_000 + 49) / r["n"]) for r in words.collect()}
    assert set(known) == {"you", "zebra", long, long[:24] + "s"} and known == pytest.approx({w: whole[w] for w in known})
    assert [segment(x, flat, known, by_beginning(known)) for x in texts] == [["you", "zebra", "you"], ["you", long, "zebra"]]
    assert [segment(x, flat, whole, by_beginning(whole)) for x in texts] == [["you", "zebra", "you"], ["you", long, "zebra"]]


def test_logistic_is_the_same_in_both_forms(spark):
    from tablewright.llm.toxicity import fit_logistic

    rng = np.random.default_rng(4)
    rows = [(sorted(rng.choice(6, i % 4, replace=False).tolist()), 5, int(rng.integers(0, 6))) for i in range(40)] + [([], 9, 0)]
    patterns = spark.createDataFrame(rows, "hits array<int>, n long, toxic long")
    assert fit_logistic(patterns, 6, 0, rounds=4) == pytest.approx(fit_logistic(patterns, 6, 1_000, rounds=4), abs=1e-9)


def test_toxicity_counts_and_joins_in_small_pieces(spark):
    """Counts passed on early, and a map too small for its ids, change nothing; equal rows count once."""
    from tablewright.llm.toxicity import counted, likely

    texts = spark.createDataFrame([(i % 2, f"moron river m o r o n w{i % 7}") for i in range(50)], "label int, t string")
    flat = np.full((SIZE, SIZE, SIZE), 5.0)
    few, once = ({(r["f"], r["bad"], r["n"]) for r in counted(texts, flat, most).collect()} for most in (3, 300_000))
    assert few == once and ("moron", 25, 50) in once and ("w-", 25, 50) not in once
    rows = spark.range(100_000)
    ids = rows.where("id % 7 = 3")
    assert [likely(rows, ids, 14_286, bits).join(ids, "id").count() for bits in (2 ** 15, 2 ** 27)] == [14_286, 14_286]
    assert likely(rows, ids, 14_286).count() < 25_000
    docs = [(i % 60, f"river {'stone' if i % 2 else 'moron'} {i % 60}") for i in range(180)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)], "doc_id long, label int")
    thrice, single = (sorted({(r["doc_id"], round(r["score"], 9)) for r in score_toxicity(spark.createDataFrame(d, "doc_id long, text string"), labels).collect()}) for d in (docs, docs[:60]))
    assert thrice == single and [x[1] >= 0.5 for x in thrice] == [i % 2 == 0 for i in range(60)]


def test_pipeline_stages(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet").limit(120)
    first = corpus_pipeline.quality_stage(spark, docs, data)
    assert first.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r["doc_id"] for r in kept_only(quality_rules(docs)).select("doc_id").collect()}
    assert {r["doc_id"] for r in first.collect()} == kept
    nothing = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, data)
        assert out.count() == 0, name
        assert name == "packing" or out.columns == first.columns


def test_plain_words_take_the_short_way_to_the_same_ids():
    import public_tokenizers
    from tablewright.llm.packing import WordIds

    ids = WordIds(public_tokenizers.path("word_bpe_49k.json"))
    want = lambda w: np.array(ids.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
    for word in ("Straße", "Éclair", "it's", "<|end|>", "a1b2", "İstanbul", "ﬁne", "", "word,", "½", "x" * 300):
        assert ids[word] == want(word), word
    ids.plain = None  # words of ASCII letters are not looked at by a pattern
    for word in ("word", "Word", "WORD", "supercalifragilistic" * 4, "q"):
        assert ids[word] == want(word), word
