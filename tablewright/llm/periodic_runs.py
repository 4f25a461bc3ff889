"""Periodic runs: stretches of words that repeat with a period, found by seeds that are extended along diagonals.

A run of period ``q`` is a longest stretch whose words equal those ``q`` places on, ``q`` being its smallest period, that
has at least ``least_words`` words and ``least_periods`` periods.

*Seeds.* The stretch and its copy ``q`` places on overlap in at least ``max(least_words - q, (least_periods - 1) * q)`` words.
The smallest such overlap over all ``q`` (16 words for 24 words and three periods) is the length ``k`` of the first grams; they
serve the lags up to ``k``. Grams of twice that length serve the lags above ``k`` up to ``2 * k``, which overlap in more than
``2 * k`` words, and so on. A gram is thus never shorter than its lags, and then only neighbouring occurrences need be paired:
were the same gram met between two places one period apart, the run would have a smaller period. So each length gives
at most one pair a word, also in a text of one word throughout. Grams are named by pairs of names of half
their length, which is exact, and only those that occur twice in their document are kept from one length to the next.

*Diagonals.* A seed at word ``i`` with lag ``q`` is extended to both sides while words ``q`` apart agree. The table of each lag's
furthest covered word drops every further seed of the same stretch.

Documents are read in lots of ``lot_words`` words by tasks that never exchange rows. Work is ``n * log(n)`` for a text of ``n`` words
and memory is bounded by a lot and the longest text.

Defined results: a null or empty text has no words and no runs; words are the stretches between ASCII white space, compared as
bytes; repeated rows and repeated ids give a row each; among equal exponents ``best`` is the run of smallest start, then period;
an empty table gives an empty table; further columns of the input are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = "struct<start: bigint, length: bigint, period: bigint>"
SCHEMA = f"id bigint, n_words bigint, runs array<{RUN}>, best {RUN}, collapsed binary"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_KINDS = [pa.int64(), pa.int64(), pa.list_(_RUN), _RUN, pa.binary()]
_NAMES = ["id", "n_words", "runs", "best", "collapsed"]
Run = tuple[int, int, int]  # start, length, period


def first_gram(least_words: int, least_periods: int) -> int:
    """The smallest overlap that a run of any period has with its copy one period on."""
    return min(max(least_words - q, (least_periods - 1) * q) for q in range(1, least_words + 1))


class Grams:
    """Names of the grams of one length that occur at least twice; -1 elsewhere."""

    def __init__(self, at: np.ndarray, key: np.ndarray, places: int):
        """``at`` are ascending places, ``key`` tells their grams apart."""
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        number = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]]) - 1 if len(key) else ordered
        twice = np.bincount(number)[number] > 1 if len(key) else np.zeros(0, bool)
        #: Places by gram, then by place, and the gram of each.
        self.listed, self.number = at[order[twice]], number[twice]
        self.name = np.full(places, -1, np.int64)
        self.name[self.listed] = self.number

    def joined(self, shift: int) -> Grams:
        """Grams longer by ``shift``: one from here and one ``shift`` places on."""
        at = np.sort(self.listed)
        at = at[at + shift < len(self.name)]
        second = self.name[at + shift]
        at, second = at[second >= 0], second[second >= 0]
        return Grams(at, self.name[at] * (len(self.name) + 1) + second, len(self.name))

    def neighbours(self, above: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and lags of neighbouring occurrences with ``above < lag <= most``, by place."""
        place, lag = self.listed[:-1], np.diff(self.listed)
        fits = (np.diff(self.number) == 0) & (lag > above) & (lag <= most)
        place, lag = place[fits], lag[fits]
        order = np.argsort(place, kind="stable")
        return place[order], lag[order]


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements are equal; looks at blocks of growing size."""
    done, size = 0, 32
    while done < min(len(a), len(b)):
        x, y = a[done:done + size], b[done:done + size]
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        if len(differ):
            return done + int(differ[0])
        done, size = done + n, 2 * size
    return done


def find_runs(texts: list[np.ndarray], least_words: int, least_periods: int) -> list[list[Run]]:
    """The runs of each text, given as word numbers that the texts share, by start and period."""
    stops = np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)
    places = int(stops[-1]) + 1 if texts else 1
    # Every text lies between two numbers that occur nowhere else, so no extension leaves it.
    word, document = -1 - np.arange(places, dtype=np.int64), np.zeros(places, np.int64)
    for k, (x, stop) in enumerate(zip(texts, stops)):
        word[stop - len(x):stop], document[stop - len(x):stop] = x, k
    at = np.flatnonzero(word >= 0)
    grams = Grams(at, document[at] * (int(word.max(initial=0)) + 1) + word[at], places)
    first, length = first_gram(least_words, least_periods), 1
    while length < first:
        shift = min(length, first - length)
        grams, length = grams.joined(shift), length + shift
    found: list[list[Run]] = [[] for _ in texts]
    covered: dict[int, int] = {}
    above = 0
    while len(grams.listed):
        covered.clear()
        place, lag = grams.neighbours(above, length)
        for i, q in zip(place.tolist(), lag.tolist()):
            if covered.get(q, 0) > i:
                continue
            left = agreeing(word[:i][::-1], word[:i + q][::-1])
            end = i + q + length + agreeing(word[i + length:], word[i + q + length:])
            covered[q] = end - q
            if end - i + left >= max(least_words, least_periods * q):
                k = int(document[i])
                found[k].append((i - left - int(stops[k]) + len(texts[k]), end - i + left, q))
        grams, above, length = grams.joined(length), length, 2 * length
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def greatest(runs: list[Run]) -> Run | None:
    """The run of the greatest exact length by period; of equal ones the first."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run covers after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, least_words: int = 24, least_periods: int = 3,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None, lot_words: int = 250_000,
) -> DataFrame:
    """One row per document: ``runs`` by start and period, the ``best`` of them, and the text with one period of each.

    ``rewrite`` may replace a document's words before they are looked at. Three periods are the least that
    the pairing of neighbouring grams can promise, so a smaller ``least_periods`` is an error.
    """
    if least_periods < 3 or least_words < 1:
        raise ValueError("runs need at least three periods and one word")

    def rows(lot: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        number: defaultdict[bytes, int] = defaultdict(count().__next__)
        texts = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for _, words in lot]
        out = []
        for (key, words), runs in zip(lot, find_runs(texts, least_words, least_periods)):
            shown = [dict(zip(("start", "length", "period"), r)) for r in runs]
            best = shown[runs.index(greatest(runs))] if runs else None
            out.append((key, len(words), shown, best, b" ".join(kept_words(words, runs))))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, held = [], 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (value.as_py() or b"").split()
                lot.append((key, rewrite(key, words) if rewrite else words))
                held += len(words) + 1
                if held >= lot_words:
                    yield rows(lot)
                    lot, held = [], 0
        if lot:
            yield rows(lot)

    read = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"))
    found = read.mapInArrow(run, SCHEMA)
    return found.select(F.col("id").alias(id), "n_words", "runs", "best", F.col("collapsed").cast("string").alias("collapsed"))
