r"""Chat formatting at token level: segments are encoded apart, and reserved ids are spliced between them.

A turn becomes ``<s>[INST]role[/INST]text</s>``. Each of the four control strings is one reserved id above the vocabulary. Role
and text are encoded on their own, as ordinary text, so no merge crosses a border and content can never give a reserved id.
Control strings met inside a role or a text are escaped as well, so that the formatted text can be told apart like the ids: a
backslash goes behind the first character, and another one if there are some already (``<s>`` becomes ``<\s>``, ``<\s>`` becomes
``<\\s>``); reading back takes one away.

Lengths of segments become borders by a prefix sum; +1 where a text of a trained role begins and -1 where it ends become the loss
mask by another one. So the mask covers those texts whole and nothing else.

Rows are dealt and sorted by range over conversation, turn, role and text; a conversation of very many rows is spread over tasks
like any other rows. Tasks read their rows as a stream and write a conversation in parts of at least
``part_tokens`` tokens, cut between turns; nearly all conversations are one part. Memory is bounded by a batch, a part and the
longest text.

Defined results: turns go by number, null first, then by role and text; a null role or text is empty, and a null conversation id is
a conversation of its own; repeated rows stay as turns of their own; runs of white space over 1,000 characters are encoded
as one piece, which is what the pattern of the vocabulary means by them; text that is not UTF-8 is read with replacement characters;
an empty table gives an empty table; further columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "conv_id bigint, part bigint, n_turns bigint, n_tokens bigint, ids array<int>, loss_mask array<tinyint>, text string"
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int8()), pa.string()]
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_DIGEST_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_LOADED: dict[str, Vocabulary] = {}
_SPACES = regex.compile(r"\p{White_Space}{1000,}")


@dataclass(frozen=True)
class Template:
    """Control strings around the role and the text of a turn, and the roles whose texts are trained on."""

    begin: str = "<s>"
    role: str = "[INST]"
    text: str = "[/INST]"
    end: str = "</s>"
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        rest = "".join(x[1:] for x in self.controls)
        if len(set(self.controls)) < 4 or any(len(x) < 2 or x[0] in rest + "\\" for x in self.controls) or "\\" in rest:
            raise ValueError("control strings must differ, have two characters, no backslash, and a first one that none has later")

    @property
    def controls(self) -> tuple[str, ...]:
        return self.begin, self.role, self.text, self.end

    def _sub(self, before: str, after: str, content: str) -> str:
        if not any(x[1:] in content for x in self.controls):  # most content; far cheaper than the pattern
            return content
        pattern = "|".join(f"(?<={re.escape(x[0])}){before}(?=\\\\*{re.escape(x[1:])})" for x in self.controls)
        return re.sub(pattern, after, content)

    def escape(self, content: str) -> str:
        return self._sub("", r"\\", content)

    def unescape(self, content: str) -> str:
        return self._sub(r"\\", "", content)


class Vocabulary:
    """Byte-level token ids of a rank file; ids from ``reserved`` on belong to the template."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.reserved = max(ranks.values()) + 2  # the id after the last rank is the vocabulary's own end of text
        self.bytes = self.coder.decode_bytes

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """The vocabulary of this worker; read once."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def encode(self, text: str) -> list[int]:
        """Long white space goes past the pattern search, which would otherwise need a stack as deep as the run is long."""
        ids, done = [], 0
        for run in _SPACES.finditer(text) if len(text) >= 1000 else ():
            last = run.end() if run.end() == len(text) else run.end() - 1  # the last one belongs to the word behind it
            ids += self.coder.encode_ordinary(text[done:run.start()])
            ids += self.coder._encode_single_piece(text[run.start():last])
            done = last
        return ids + self.coder.encode_ordinary(text[done:] if done else text)

    def decode(self, ids: Sequence[int]) -> str:
        return self.bytes(ids).decode("utf-8")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def assemble(turns: list[tuple[str, str]], template: Template, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, str]:
    """Ids, loss mask and formatted text of consecutive turns."""
    begin, role_id, text_id, end = range(vocabulary.reserved, vocabulary.reserved + 4)
    ids, lengths, trained, shown = [], [], [], []
    for role, text in turns:
        roles, texts = template.escape(role), template.escape(text)
        segments = [begin, role_id], vocabulary.encode(roles), [text_id], vocabulary.encode(texts), [end]
        for segment in segments:
            ids += segment
        lengths += map(len, segments)
        trained += [0, 0, 0, role in template.trained, 0]
        shown += [template.begin, template.role, roles, template.text, texts, template.end]
    borders = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    chosen = np.flatnonzero(trained)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, borders[chosen], 1)
    np.add.at(change, borders[chosen + 1], -1)
    return np.array(ids, np.int32), np.cumsum(change[:-1]).astype(np.int8), "".join(shown)


def _text(value: pa.Scalar) -> str:
    return (value.as_py() or b"").decode("utf-8", "replace")


def format_chat(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *,
    template: Template = Template(), vocabulary: str | None = None, part_tokens: int = 1 << 16,
) -> DataFrame:
    """One row per part of a conversation; ``part`` orders the parts of a conversation, its numbers have gaps.

    ``ids`` and ``loss_mask`` are as long as each other, ``text`` is what the ids stand for.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.of(path)
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        turns: list[tuple[str, str]] = []
        held, size, now = 0, 0, None

        def close() -> None:
            nonlocal held, size, number
            if turns:
                ids, mask, shown = assemble(turns, template, words)
                rows.append((now, number, len(turns), len(ids), ids, mask, shown))
                number, held, size = number + 1, held + len(ids), 0
                turns.clear()

        def batch() -> pa.RecordBatch:
            nonlocal held
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)]
            rows.clear()
            held = 0
            return pa.RecordBatch.from_arrays(columns, names=_NAMES)

        for read in batches:
            for key, who, what in zip(read.column(0).to_pylist(), read.column(1), read.column(2)):
                # a token holds at least one byte, so bytes bound the tokens of a part
                if key != now or size >= 4 * part_tokens:
                    close()
                if held >= 1 << 20:
                    yield batch()
                now = key
                turns.append((_text(who), _text(what)))
                size += len(turns[-1][1])
        close()
        if rows:
            yield batch()

    order = [F.col(id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn")]
    kept = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = conversations.select(*order, *kept)
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(64)))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", *[F.col(c).cast("binary").alias(c) for c in ("role", "text")]).mapInArrow(run, SCHEMA)


def turns_of(ids: np.ndarray, mask: np.ndarray, template: Template, vocabulary: Vocabulary) -> Iterator[tuple[str, str, list[str]]]:
    """Role, text and the pieces under the mask of each turn, read back from ids."""
    borders = np.flatnonzero(ids >= vocabulary.reserved).tolist()
    begin, role_id, text_id, end = range(vocabulary.reserved, vocabulary.reserved + 4)
    for k in range(0, len(borders), 4):
        a, b, c, d = borders[k:k + 4]
        if ids[[a, b, c, d]].tolist() != [begin, role_id, text_id, end] or b != a + 1:
            raise ValueError("the ids are not a sequence of turns")
        edge = np.diff(np.concatenate([[0], mask[a:d + 1], [0]]))
        spans = zip((np.flatnonzero(edge == 1) + a).tolist(), (np.flatnonzero(edge == -1) + a).tolist())
        role, text = vocabulary.decode(ids[b + 1:c].tolist()), vocabulary.decode(ids[c + 1:d].tolist())
        yield template.unescape(role), template.unescape(text), [template.unescape(vocabulary.decode(ids[x:y].tolist())) for x, y in spans]


def digests(formatted: DataFrame, *, template: Template = Template(), vocabulary: str | None = None) -> DataFrame:
    """One row per conversation: turns and trained texts read back from the ids of all its parts, as checksums.

    A checksum over a conversation is a chain, so its parts pass one task in order. They are read as a stream, whatever their number.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rows, now, state = Vocabulary.of(path), [], None, None

        def parts() -> Iterable[tuple]:
            for read in batches:
                yield from zip(read.column(0).to_pylist(), read.column(2), read.column(3), read.column(4).to_pylist())

        def close() -> None:
            if state is not None:
                turns, whole, chars, loss, shown = state
                rows.append((now, turns, whole.hexdigest(), chars, loss.hexdigest(), shown))

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _DIGEST_KINDS)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in DIGEST.split(", ")])

        for key, ids, mask, shown in parts():
            if state is None or key != now:
                close()
                now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if len(rows) >= 10_000:
                    yield batch()
            for role, text, trained in turns_of(np.asarray(ids.values), np.asarray(mask.values), template, words):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                for piece in trained:
                    state[2] += len(piece)
                    state[3].update(piece.encode())
            state[4] += shown
        close()
        if rows:
            yield batch()

    read = formatted.select("conv_id", "part", "ids", "loss_mask", F.length("text").cast("bigint").alias("chars"))
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, DIGEST)
