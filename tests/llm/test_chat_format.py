"""Exact round trips of formatted conversations, and the cases the docstring defines."""

import hashlib
import random

import numpy as np
import pytest

from tablewright.llm.chat_format import Template, Vocabulary, assemble, default_vocabulary, digests, format_chat, turns_of

PIECES = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "é", "日本", "ok ", "\n", " ", "<|endoftext|>", "🙂"]


def said(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))


def wanted(turns, template=Template()):
    """Checks by hand, from the turns alone; spelled out character by character."""
    def escaped(x):
        out, i = [], 0
        while i < len(x):
            out.append(x[i])
            for c in template.controls:
                j = i + 1
                while x[i] == c[0] and j < len(x) and x[j] == "\\":
                    j += 1
                if x[i] == c[0] and x.startswith(c[1:], j):
                    out.append("\\")
                    break
            i += 1
        return "".join(out)

    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    shown = "".join(f"<s>[INST]{escaped(r)}[/INST]{escaped(t)}</s>" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(shown)


@pytest.fixture(scope="module")
def words():
    return Vocabulary.of(default_vocabulary())


def test_escapes_are_exact_and_hide_every_control():
    template, rng = Template(), random.Random(5)
    for _ in range(3000):
        text = said(rng)
        hidden = template.escape(text)
        assert template.unescape(hidden) == text
        assert not any(c in hidden for c in template.controls)
    assert template.escape("<s><\\s>[\\\\/INST]") == "<\\s><\\\\s>[\\\\\\/INST]"


def test_template_must_be_told_apart():
    for bad in (dict(begin="x"), dict(begin="</s>"), dict(begin="s>"), dict(role="[a<b]"), dict(text="\\x")):
        with pytest.raises(ValueError):
            Template(**bad)
    marks = Template("<|start|>", "{role}", "{text}", "<|end|>", ("model",))
    assert marks.unescape(marks.escape("<|end|>{role}")) == "<|end|>{role}"


def test_assembly_reads_back(words):
    rng, template = random.Random(6), Template()
    for _ in range(200):
        turns = [(rng.choice(["user", "assistant", "system", "", "a[/INST]"]), said(rng)) for _ in range(rng.randint(1, 6))]
        ids, mask, text = assemble(turns, template, words)
        assert len(ids) == len(mask) and set(mask.tolist()) <= {0, 1}
        strings = dict(zip(range(words.reserved, words.reserved + 4), template.controls))
        assert "".join(strings[i] if i in strings else "" for i in ids.tolist()) == "<s>[INST][/INST]</s>" * len(turns)
        plain, at = [], 0
        for i in [*np.flatnonzero(ids >= words.reserved).tolist(), len(ids)]:
            plain.append(words.decode(ids[at:i].tolist()))
            plain.append(strings[int(ids[i])] if i < len(ids) else "")
            at = i + 1
        assert "".join(plain) == text
        back = list(turns_of(ids, mask, template, words))
        assert [(r, t) for r, t, _ in back] == turns
        assert ["".join(p) for _, _, p in back] == [t if r == "assistant" else "" for r, t in turns]


def test_long_white_space_is_encoded_as_its_pattern_says(words):
    for text in ("a" + " " * 3000 + "b", " " * 1000, "x\n" * 10 + "\n" * 1500 + " y  z", " " * 1200 + "!", "a" + " " * 999 + "b"):
        assert words.encode(text) == words.coder.encode_ordinary(text)
    for text in (" " * 200_000, "q" + "\t" * 200_000 + "r" + "\n" * 100_000, "a" * 200_000):
        assert words.decode(words.encode(text)) == text


ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 1, "assistant", "again"), (1, None, "system", "first"),
    (2, 0, None, None), (2, 1, "assistant", ""), (2, 1, "assistant", ""),
    (3, 0, "assistant", "word " * 40_000), (3, 1, "user", " " * 20_000), (None, 5, "user", "no id"), (None, 4, "assistant", "<s>"),
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def grouped(rows):
    out = {}
    for key, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(key, []).append((role or "", text or ""))
    return out


@pytest.mark.parametrize("part_tokens", [1, 1 << 16])
def test_round_trip_of_a_table(spark, part_tokens):
    rng = random.Random(7)
    rows = ROWS + [(9, k, "user" if k % 2 else "assistant", said(rng)) for k in range(600)]
    rows += [(100 + k, t, rng.choice(["user", "assistant", "tool"]), said(rng)) for k in range(60) for t in range(rng.randint(1, 5))]
    table = spark.createDataFrame([r + (0, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, ids string")
    formatted = format_chat(table.repartition(5), part_tokens=part_tokens).cache()
    got = {r["conv_id"]: tuple(r)[1:] for r in digests(formatted).collect()}
    assert got == {k: wanted(v) for k, v in grouped(rows).items()}
    assert formatted.where("size(ids) != size(loss_mask) OR size(ids) != n_tokens").count() == 0
    parts = formatted.where("conv_id = 9").orderBy("part").collect()
    assert len(parts) > 50 if part_tokens == 1 else len(parts) < 9
    assert len("".join(p["text"] for p in parts)) == got[9][4]
    formatted.unpersist()


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(format_chat(none)).collect() == []
