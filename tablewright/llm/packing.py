"""Cost-balanced packing: tokens into sequences of a fixed length with evenly spread attention cost.

A piece of ``n`` tokens costs ``linear * n + quadratic * n * n``, as attention stays inside a document.
Documents are taken in descending cost, and each goes to the sequence of the lowest cost so far that has
room for it; what fits nowhere whole is cut over the room that is left, cheapest sequence first. The
room offered is exactly what the documents need: full sequences and, once per input partition, a rest in
sequences of powers of two, which need no padding. So no token is padding.

Each task tokenizes its partition and packs it in lots of ``lot_tokens`` tokens: nothing is shuffled, no
document waits for another task, and memory is bounded by a lot and the longest document. Texts are cut
at spaces and line ends (the tokenizer drops white space and never joins across it), and each different
word is tokenized once per worker as long as the word table holds it.

The sequence number is the partition number and a counter, so the input should be a stored table:
then a task that runs again on another executor makes the same sequences.

Defined results: a null or empty text is the single end id; repeated rows and repeated ids are packed
like any others; equal costs go in input order; an empty table gives an empty table; further columns of
the input are not read.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long, ids binary"
)
_LOADED: dict[str, tuple] = {}
#: Writers of short lists of ids.
PACKED = [struct.Struct(f"<{n}I").pack for n in range(16)]


class WordIds(dict):
    """Token ids of words as bytes (unsigned 32 bit, little endian), made when a word is first looked up.

    A word of common Latin characters is cut by the tokenizer's own pattern and each piece is merged by
    its model alone; all other words go through the whole tokenizer. When the table is full it becomes
    the old one and a new one begins; words met again are taken over, so only words that were not met
    during a whole table are tokenized again.
    """

    def __init__(self, path: str, most_words: int = 1_000_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most, self.old = Tokenizer.from_file(path), most_words, {}
        self.merge, self.pieces = self.tokenizer.model.tokenize, self._pattern(path)
        # Normal form C leaves these alone, and lower() gives one letter for one; no white space but the blank.
        self.plain = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]*").fullmatch
        # A byte-level model writes a byte as the character of that number, or from 256 on if that is not printable.
        hidden = [n for n in range(256) if not (33 <= n <= 126 or 161 <= n <= 255 and n != 173)]
        self.shown = "".join(chr(256 + hidden.index(n) if n in hidden else n) for n in range(256))
        self.piece = lru_cache(200_000)(self._piece)  # stops, marks and frequent words of other spelling

    @staticmethod
    def _pattern(path: str):
        """The pattern that finds pieces, or None for a tokenizer built otherwise than the plain way expects."""
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        normal = [x["type"] for x in (rules.get("normalizer") or {}).get("normalizers", [])]
        cut = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if normal != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in cut] != ["Split", "ByteLevel"] or \
                not cut[0]["invert"] or cut[1]["add_prefix_space"] or cut[1]["use_regex"]:
            return None
        return regex.compile(cut[0]["pattern"]["Regex"]).findall

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        seen = piece if piece.isascii() else codecs.charmap_decode(piece.encode(), "strict", self.shown)[0]
        ids = [t.id for t in self.merge(seen)]
        return PACKED[len(ids)](*ids) if len(ids) < len(PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        found = self.old.get(word)
        if found is None:
            if self.pieces is None:
                found = self._whole(word)
            elif word.isalpha() and word.isascii():  # most words; they are plain and one piece
                found = self.piece(word.lower())
            elif "<|" in word or not self.plain(word):
                found = self._whole(word)
            else:
                low = word.lower()
                found = self.piece(low) if low.isalpha() else b"".join(map(self.piece, self.pieces(low)))
        self[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def capacities(total: int, length: int) -> list[int]:
    """Full sequences, and the rest as powers of two, largest first."""
    rest = total % length
    return [length] * (total // length) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def assign(sizes: list[int], room: list[int], linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """For each sequence its pieces (document, start, length); sizes and room have the same sum."""
    left, cost = np.array(room, np.int64), np.zeros(len(room))
    filled: list[list[tuple[int, int, int]]] = [[] for _ in room]
    longest = max(room, default=0)

    def put(s: int, doc: int, start: int, n: int) -> None:
        filled[s].append((doc, start, n))
        left[s] -= n
        cost[s] = cost[s] + linear * n + quadratic * n * n if left[s] else np.inf

    items, at = [], 0
    for doc, n in enumerate(sizes):
        start = 0
        while n - start >= longest and at < len(room) and room[at] == longest:  # whole sequences of one document
            put(at, doc, start, longest)
            start, at = start + longest, at + 1
        if n > start:
            items.append((doc, start, n - start))
    over = []
    for doc, start, n in sorted(items, key=lambda x: -(linear * x[2] + quadratic * x[2] * x[2])):
        fits = np.where(left >= n, cost, np.inf)
        s = int(fits.argmin()) if len(fits) else 0
        if len(fits) and np.isfinite(fits[s]):
            put(s, doc, start, n)
        else:
            over.append((doc, start, n))
    for doc, start, n in over:
        while n:
            s = int(cost.argmin())
            part = int(min(n, left[s]))
            put(s, doc, start, part)
            start, n = start + part, n - part
    return filled


def packed(
    docs: Iterable[tuple[int | None, bytes]], first: int, length: int, lot_tokens: int, linear: float, quadratic: float, with_ids: bool,
) -> Iterator[list[tuple]]:
    """Lists of pieces; ``docs`` are ids as bytes. ``first`` is the first sequence number."""
    lot: list[tuple[int | None, bytes, int]] = []  # id, its ids from here on, how many ids came before
    held, number = 0, first

    def flush(cut: int) -> list[tuple]:
        """Packs ``cut`` tokens from the front of the lot."""
        nonlocal lot, held, number
        sizes, taken, rest = [], 0, []
        for doc, ids, before in lot:
            n = min(len(ids) // 4, cut - taken)
            sizes.append(n)
            taken += n
            if n < len(ids) // 4:
                rest.append((doc, ids[4 * n:], before + n))
        out = []
        for pieces in assign(sizes, capacities(taken, length), linear, quadratic):
            offset, whole = 0, sum(p[2] for p in pieces)
            for k, start, n in pieces:
                doc, ids, before = lot[k]
                part = ids[4 * start:4 * (start + n)]
                out.append((doc, before + start, n, zlib.crc32(part), totals[k], number, offset, whole, part if with_ids else None))
                offset += n
            number += 1
        kept = [totals[k] for k, n in enumerate(sizes) if n < len(lot[k][1]) // 4]
        lot, held = rest, held - taken
        totals[:] = kept
        return out

    totals: list[int] = []
    for doc, ids in docs:
        lot.append((doc, ids, 0))
        totals.append(len(ids) // 4)
        held += len(ids) // 4
        if held >= lot_tokens:
            yield flush(held - held % length)
    if held:
        yield flush(held)


def pack(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, tokenizer: str | None = None, end_id: int = 1, length: int = 2048,
    lot_sequences: int = 512, linear: float = 1.0, quadratic: float = 1.0 / 2048, with_ids: bool = True,
) -> DataFrame:
    """One row per piece; ``ids`` holds the token ids of the piece (unsigned 32 bit, little endian)."""
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    end = np.array([end_id], "<u4").tobytes()
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 8 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of = _LOADED.setdefault(tokenizer, WordIds(tokenizer)) if tokenizer not in _LOADED else _LOADED[tokenizer]

        def texts():
            for batch in batches:
                for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    value = value.as_py()
                    yield doc, (ids_of(value) if value else b"") + end

        first = TaskContext.get().partitionId() << 32
        for pieces in packed(texts(), first, length, lot_sequences * length, linear, quadratic, with_ids):
            for i in range(0, len(pieces), 10_000):
                columns = zip(*pieces[i:i + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
