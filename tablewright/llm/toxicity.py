"""Toxicity by noisy-channel deobfuscation.

1. A character language model is counted over all documents: trigrams of a fixed alphabet, one bounded table
   of sums per task.
2. Tokens that hold figures or signs among letters, inner marks, letters three in a row, and runs of
   spaced single letters are read as lattices: each character offers the letters it may stand for (itself,
   its leetspeak readings, the Latin letter it looks like, nothing for a repetition, nothing or a word boundary
   for a separator, where a gap wider than the narrowest is most likely a boundary) at a channel cost. Viterbi
   decoding under the language model picks the likeliest words. Other tokens have a single path and stay.
3. Runs of single letters have a second reading: their letters cut into words by the words that two or more labelled
   texts hold, other words as the model spells them. The words of both readings count.
4. The restored text is scored by a logistic model over words and word beginnings. Those are chosen by
   counts, and their weights fitted, on all labelled documents; equal texts count once.

Nothing is sampled and no table is cut at a size: labelled texts, counts and chosen features stay in tables. The driver
and each worker hold the features of the model (each is in 1 of 250 toxic texts at least, or in two where these are few, so
their number follows the length of a text) and, of the words known, those that stand somewhere inside a run (no other
can change how a run is cut). Texts with equal features are one row with a number; up to ``in_memory`` features of such
rows are fitted by the driver, more by one job a round, with the same steps.

Tokens and runs are decoded whole whatever their length, in time and memory linear in it. Features of tokens are kept in a
table of bounded size per worker, as texts repeat their words; long ones are decoded anew each time.

Defined results: null and empty texts score as the model scores a text without features; without labels of both
kinds every score is the share of toxic labels (0 without any); null labels are left out, of several labels of one id the largest holds; repeated
rows are scored one by one; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import stored

#: Letters of a run that are read as one word at most, where no longer word is known.
LONGEST = 24
#: Letters of the language model after the blank; all other characters share the last place.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßñáéíóúàâçèêëîïôùûœæìòãõåø"
SIZE = 64
#: Fixed readings of signs and figures as letters.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e", "£": "l", "(": "c",
}
SIGNS = "0-9@$!|+€£("
PLACE = {" ": 0} | {c: i + 1 for i, c in enumerate(LETTERS)}
#: Letters of other scripts that look like a Latin one; they may also stand for themselves.
ALIKE = dict(zip("авсԁеһіјкмпорԛгѕтуѵԝхαβεικνορτυχγ", "abcdehijkmnopqrstyvwxabeiknoptuxy"))
OTHER = rf"(?:(?![{LETTERS}])[^\W\d_])"
SPACED = re.compile(r"(?<!\S)(?:[^\W_][ .\-_*]+){2,}[^\W_](?![^\s.,;:!?\"'`´”’)\]}>…])")
WORD = re.compile(r"[^\W\d_]+")
ODD = re.compile(rf"[^\W\d_][{SIGNS}.\-_*]+[^\W\d_]|[{SIGNS}][^\W\d_]|[^\W\d_][0-9@$|+€£(]|([^\W\d_])\1\1|[{LETTERS}]{OTHER}|{OTHER}[{LETTERS}]")
EDGES = ".,;:!?\"'`´“”‘’()[]{}<>…"
COSTS = {"reading": 0.7, "separator": 0.3, "joined gap": 3.0, "unknown": 2.0, "repetition": 0.5, "other": 2.0}
SEPARATORS = " .-_*'"
PARTS = re.compile(r"[ .\-_*']+|[^ .\-_*']", re.S)


def _codes() -> np.ndarray:
    table = np.full(0x250, SIZE - 1, np.int64)
    for c, i in PLACE.items():
        table[ord(c)] = i
    table[[9, 10, 11, 12, 13]] = 0
    return table


def trigrams(docs: DataFrame, text: str) -> DataFrame:
    """(gram, n): counts of the character trigrams of all texts, at most 64^3 rows."""
    codes = _codes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE ** 3, np.int64)

        def add(texts: list[str]) -> None:
            points = np.frombuffer(("  " + "  ".join(texts) + "  ").encode("utf-32-le", "replace"), np.uint32)
            c = codes[np.minimum(points, len(codes) - 1)]
            counts[:] += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)

        for batch in batches:
            texts, held = [], 0
            for value in batch.column(0):
                texts.append((value.as_py() or "").lower())
                held += len(texts[-1])
                if held > 1_000_000:
                    add(texts)
                    texts, held = [], 0
            add(texts)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["gram", "n"])

    return docs.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def lowered(text: str | None) -> str:
    """Lower case, with wide, styled and ligature forms as plain letters."""
    text = text or ""
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower()


def alike(c: str) -> str:
    """The Latin letter that a letter outside the alphabet looks like, or nothing."""
    base = ALIKE.get(c) or unicodedata.normalize("NFKD", c)[0]
    return base if base in PLACE else ""


def character_costs(grams: list) -> np.ndarray:
    counts = np.zeros(SIZE ** 3)
    for g in grams:
        counts[g["gram"]] = g["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    # three of one letter in a row are stretched words, which must not teach the model
    k = np.arange(1, SIZE - 1)
    counts[k, k, k] = 0
    counts = counts + 0.1
    return -np.log(counts / counts.sum(2, keepdims=True))


def decode(token: str, costs: np.ndarray) -> str:
    """The likeliest words, parted by blanks, behind an obfuscated token or a run of spaced letters."""
    # a path is its cost and its last letter, which points back to the letter before
    paths: dict = {(0, 0): (0.0, None)}
    last = ""
    items = [x[0] for x in PARTS.finditer(token)]
    # a gap wider than the narrowest one is most likely a word boundary
    narrow = min((len(x) for x in items if x[0] in SEPARATORS), default=0)
    for c in items:
        offers = []
        if c[0] in SEPARATORS:
            wide = len(c) > narrow
            offers += [("", COSTS["joined gap" if wide else "separator"]), (" ", 0.0 if wide else COSTS["separator"])]
        elif c in PLACE:
            offers.append((c, 0.0))
            if c == last:
                offers.append(("", COSTS["repetition"]))
        elif c in READINGS:
            offers += [(r, COSTS["reading"]) for r in READINGS[c]]
            offers += [("", COSTS["repetition"])] if c == last else []
        elif c.isalpha():
            offers.append((c, 0.0))
            offers += [(r, COSTS["reading"]) for r in alike(c)]
            offers += [("", COSTS["repetition"])] if c == last else []
        else:
            offers.append(("", COSTS["other"]))
        last = c
        new: dict = {}
        for (a, b), (cost, end) in paths.items():
            for letter, extra in offers:
                if letter:
                    p = PLACE.get(letter, SIZE - 1)
                    key, value = (b, p), cost + extra + costs[a, b, p]
                else:
                    key, value = (a, b), cost + extra
                if key not in new or value < new[key][0]:
                    new[key] = (value, (end, letter) if letter else end)
        paths = new
    end = min(((cost + costs[a, b, 0], a, b), end) for (a, b), (cost, end) in paths.items())[1]
    letters = []
    while end:
        end, letter = end
        letters.append(letter)
    return "".join(reversed(letters))


def by_beginning(known: dict[str, float], longest: int = LONGEST) -> dict[str, list[str]]:
    """The known words of more than ``longest`` letters under their first ones."""
    out: dict[str, list[str]] = {}
    for word in known:
        if len(word) > longest:
            out.setdefault(word[:longest], []).append(word)
    return out


def segment(letters: str, costs: np.ndarray, known: dict[str, float], long: dict[str, list[str]], longest: int = LONGEST) -> list[str]:
    """The likeliest words of joined letters: known ones at their cost, others (up to ``longest`` letters) as the model spells them.

    ``long`` holds the known words above that length, from ``by_beginning``.
    """
    places = [PLACE.get(c, SIZE - 1) for c in letters]
    best, back = [0.0] + [np.inf] * len(letters), [0] * (len(letters) + 1)
    for i in range(len(letters)):
        a = b = 0
        spelled = COSTS["unknown"]
        for j in range(i, min(len(letters), i + longest)):
            spelled += costs[a, b, places[j]]
            a, b = b, places[j]
            cost = best[i] + known.get(letters[i:j + 1], spelled + costs[a, b, 0])
            if cost < best[j + 1]:
                best[j + 1], back[j + 1] = cost, i
        for word in long.get(letters[i:i + longest], ()):
            if letters.startswith(word, i) and best[i] + known[word] < best[i + len(word)]:
                best[i + len(word)], back[i + len(word)] = best[i] + known[word], i
    words, end = [], len(letters)
    while end:
        words.append(letters[back[end]:end])
        end = back[end]
    return words[::-1]


def features(words: Iterable[str]) -> set[str]:
    """Words and, marked by a stroke, their beginnings."""
    return {*words, *(w[:n] + "-" for w in words for n in (4, 5, 6) if len(w) > n)}


class Restorer:
    """Features of a text after restoration, as ``numbered`` gives them.

    Tokens of all lengths are decoded; the table they are looked up in keeps at most ``most`` of up to ``longest`` characters.
    """

    def __init__(self, costs: np.ndarray, numbered: Callable[[set[str]], Iterable[int]], most: int = 300_000, longest: int = 60):
        self.costs, self.numbered, self.most, self.longest, self.known = costs, numbered, most, longest, {}

    def token(self, token: str) -> tuple[int, ...]:
        found = self.known.get(token)
        if found is None:
            bare = token.strip(EDGES)
            words = {bare} if bare.isalpha() else set(WORD.findall(token))
            if ODD.search(bare):
                words.update(decode(token.strip(".,;:?\"'()[]{}<>…"), self.costs).split())
            found = tuple(self.numbered(features(words)))
            if len(token) <= self.longest:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[token] = found
        return found

    def __call__(self, text: str | None) -> tuple[set[int], list[str]]:
        """Numbers of the text's features, and the joined letters of its runs, which ``segment`` reads again."""
        text = lowered(text)
        out: set[int] = set()
        for token in set(text.split()):
            out.update(self.token(token))
        letters = []
        for run in dict.fromkeys(SPACED.findall(text)):
            # with the boundaries of the lattice
            found = decode(run, self.costs).split()
            out.update(self.numbered(features(found)))
            letters.append("".join(found))
        return out, letters


def counted(texts: DataFrame, costs: np.ndarray, most: int = 300_000) -> DataFrame:
    """(f, bad, n): of the texts (label, t), how many toxic ones and how many in all have a feature.

    A task passes its counts on whenever it holds ``most`` features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        restore = Restorer(costs, lambda found: [names.setdefault(f, len(names)) for f in found])
        all_, bad = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            size = len(names)
            out = pa.RecordBatch.from_arrays([
                pa.array(list(names), pa.string()), pa.array((bad[i] for i in range(size)), pa.int64(), size=size),
                pa.array((all_[i] for i in range(size)), pa.int64(), size=size)], names=["f", "bad", "n"])
            for held in (names, restore.known, all_, bad):
                held.clear()
            return out

        for batch in batches:
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, letters = restore(value.as_py())
                for joined in letters:
                    found.update(restore.numbered(features(segment(joined, costs, {}, {}))))
                all_.update(found)
                if label:
                    bad.update(found)
                if len(names) >= most:
                    yield flush()
        yield flush()

    return texts.select("label", "t").mapInArrow(run, "f string, bad long, n long").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))


def known_words(words: DataFrame, runs: DataFrame, most: int = 300_000) -> dict[str, float]:
    """The costs of those of the words (f, n) that may stand inside a run of the column ``letters``: all that ``segment`` can use.

    Words of more than ``LONGEST`` letters are looked up by their first ones. A task keeps ``most`` pieces to pass each on once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            for value in batch.column(0):
                letters = value.as_py()
                for i in range(len(letters)):
                    seen.update(letters[i:j] for j in range(i + 1, min(len(letters), i + LONGEST) + 1))
                    if len(seen) >= most:
                        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["piece"])
                        seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["piece"])

    pieces = runs.select(F.explode("letters").alias("letters")).distinct().mapInArrow(run, "piece string").distinct()
    held = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    used = words.join(pieces, F.substring("f", 1, LONGEST) == F.col("piece"), "left_semi")
    return {r["f"]: float(np.log(held / r["n"])) for r in used.collect()}


def matched(rows: DataFrame, words: DataFrame, lexicon: list[str], costs: np.ndarray) -> DataFrame:
    """(id, same, hits): for each row (id, same, t), the places of its features in the lexicon."""
    index = {f: i for i, f in enumerate(lexicon)}

    def numbered(found: set[str]) -> list[int]:
        return [index[f] for f in found if f in index]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(costs, numbered)
        for batch in batches:
            hits, runs = [], []
            for value in batch.column(2):
                found, letters = restore(value.as_py())
                hits.append(sorted(found))
                runs.append(letters or None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hits, pa.list_(pa.int32())), pa.array(runs, pa.list_(pa.string()))],
                names=["id", "same", "hits", "letters"])

    kind = rows.schema["id"].dataType.simpleString()
    found = stored(rows.select("id", "same", "t").mapInArrow(run, f"id {kind}, same string, hits array<int>, letters array<string>"), "features")
    spaced = found.where(F.col("letters").isNotNull())
    vocabulary = known_words(words, spaced)
    long = by_beginning(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for before, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                now = set(before)
                for letters in runs:
                    now.update(numbered(features(segment(letters, costs, vocabulary, long))))
                hits.append(sorted(now))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.list_(pa.int32()))], names=["id", "same", "hits"])

    again = stored(spaced.mapInArrow(cut, f"id {kind}, same string, hits array<int>"), "spaced")
    return found.where(F.col("letters").isNull()).drop("letters").unionByName(again)


def gaps(hits: pa.ListArray, n: np.ndarray, toxic: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What the model ``w`` expects above the toxic of ``n`` texts a row: the sums for each feature and, last, of all."""
    row, col = np.repeat(np.arange(len(hits)), hits.value_lengths().to_numpy()), hits.flatten().to_numpy()
    gap = n / (1 + np.exp(-(np.bincount(row, w[col], len(hits)) + w[-1]))) - toxic
    return np.r_[np.bincount(col, gap[row], len(w) - 1), gap.sum()]


def fit_logistic(patterns: DataFrame, size: int, in_memory: int, rounds: int = 400, ridge: float = 2e-4) -> np.ndarray:
    """Weights and, last, the intercept from (hits, n, toxic); features are present or not."""
    total, held = patterns.agg(F.sum("n"), F.sum(F.size("hits") + 1)).first()
    if held <= in_memory:
        table = patterns.orderBy("hits").toArrow().combine_chunks()
        lists, n, toxic = table["hits"].combine_chunks(), table["n"].to_numpy(), table["toxic"].to_numpy()

        def summed(w: np.ndarray) -> np.ndarray:
            return gaps(lists, n, toxic, w)
    else:

        def summed(w: np.ndarray) -> np.ndarray:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                g = np.zeros(size + 1)
                for batch in batches:
                    g += gaps(batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy(), w)
                there = np.flatnonzero(g)
                yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(g[there])], names=["place", "g"])

            out = np.zeros(size + 1)
            for r in patterns.select("hits", "n", "toxic").mapInArrow(run, "place long, g double").groupBy("place").agg(F.sum("g").alias("g")).collect():
                out[r["place"]] = r["g"]
            return out

    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        g = summed(w) / total + np.r_[ridge * w[:-1], 0.0]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return w


def likely(rows: DataFrame, ids: DataFrame, n: int, most_bits: int = 2 ** 27) -> DataFrame:
    """All rows with one of the ``n`` ids and few others, so that few texts travel to be joined.

    An id is a bit of a map with 16 bits or more for each; a map that would be above ``most_bits`` is that size and lets more others through.
    """
    bits = min(1 << max(15, (16 * n).bit_length()), most_bits)
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    part, bit = F.shiftright(place, 15), place.bitwiseAND(F.lit(2 ** 15 - 1))
    # at most most_bits in all: safe to broadcast
    maps = F.broadcast(ids.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(bit).alias("map")))
    byte = F.conv(F.hex(F.substring("map", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1
    return rows.join(maps, (part == F.col("part")) & there).drop("part", "map")


def learn(rows: DataFrame, labels: DataFrame, costs: np.ndarray, in_memory: int) -> tuple[DataFrame | None, np.ndarray]:
    """From labels (id, label 0/1), the rows (id, same, t) as ``matched`` gives them, and the model's weights with, last, the intercept.

    Without labels of both kinds there are no rows and the model is its intercept.
    """
    chosen = labels.where("label IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.max("label").cast("int").alias("label"))
    # one id of each labelled text; its text and its features are looked up by both
    sample = stored(rows.select("id", "same").join(chosen, "id").groupBy("same").agg(F.max("label").alias("label"), F.min("id").alias("id")), "labelled")
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < n:
        share = toxic / n if n else 0.0
        return None, np.array([np.log(max(share, 1e-9)) - np.log(max(1 - share, 1e-9))])

    least = max(2, round(0.004 * toxic))
    counts = stored(counted(likely(rows, sample, n).join(sample, ["id", "same"]).dropDuplicates(["id", "same"]), costs), "counts")
    words = counts.where((F.col("n") > 1) & ~F.col("f").endswith("-")).select("f", "n")
    lexicon = [r["f"] for r in counts.where(
        (F.col("bad") >= least) & (F.col("bad") * (n - toxic) >= 5 * toxic * (F.col("n") - F.col("bad") + 0.5))).orderBy(
        F.desc("bad"), "n", "f").select("f").collect()]
    found = matched(rows, words, lexicon, costs)
    patterns = stored(found.join(sample, ["id", "same"]).dropDuplicates(["id", "same"]).groupBy("hits").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")), "patterns")
    return found, fit_logistic(patterns, len(lexicon), in_memory)


def score_toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", *, in_memory: int = 2_000_000) -> DataFrame:
    """(id, score) for every row; ``labels`` holds id and ``label`` of the rows to learn from."""
    costs = character_costs(trigrams(docs, text).collect())
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), F.md5(t).alias("same"), t.alias("t"))
    found, w = learn(rows, labels.select(F.col(id).alias("id"), "label"), costs, in_memory)
    if found is None:
        return docs.select(F.col(id).cast("long").alias(id), F.lit(float(1 / (1 + np.exp(-w[-1])))).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(1)
            row = np.repeat(np.arange(len(hits)), hits.value_lengths().to_numpy())
            scores = 1 / (1 + np.exp(-(w[-1] + np.bincount(row, w[hits.flatten().to_numpy()], len(hits)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id, "score"])

    return found.select(F.col("id").cast("long").alias("id"), "hits").mapInArrow(run, f"`{id}` long, score double")
