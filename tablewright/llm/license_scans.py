"""License scans (native): phrases by place, and an exact set-similarity join of text blocks with license templates.

A block is a run of ``block_lines`` lines (one run from each line on), or a window of words: for each template,
windows of three times its length from every one and a half lengths on, so that any run of ``SLACK`` (1.5) times
its length is whole in one, however it is wrapped and spaced. A window is only held against templates of its own length;
texts that do not hold enough words of such a template are not cut into windows. Template and block are sets of words; a block meets a template if it contains at least
``ceil(threshold * |template|)`` of its words. The join follows the prefix-filter scheme:

* words are put in one global order, the rarest in the corpus first;
* if ``need`` words of a template are in a block, then the first ``|T| - need + 1`` words of the template
  and the first ``|B| - need + 1`` of the block share a word, so only these prefixes are joined;
* length filter: a block with fewer than ``need`` template words cannot meet it;
* positional filter: after a shared word at places i and j, at most ``1 + min(|T| - i, |B| - j)`` words
  can still be shared.

What passes is verified on the full sets, so the result is exact. Words outside all templates cannot
be shared and are left out of the block sets. The template side is bounded by the templates given
(some hundred words), and only it is broadcast; the frequencies brought to the driver are one number for
each of its words. No row is shuffled by a word, so frequent words and lines make no hot task.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows are judged one
by one; an empty table gives an empty table; ties between templates give all labels; further
columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Fixed phrases and their labels.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
#: Fixed opening sentences of well-known license notices, by label.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "bsd-terms": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under a Creative Commons Attribution 4.0 International License.",
    "public-domain": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}
#: Standard header and whole texts (without the copyright line), by label.
WHOLE = {
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
    "to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
    "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
    "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
    "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
}
#: Words of a run that is whole in a window, as a multiple of the template's length.
SLACK = 1.5


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BREAK), "")


def template_sets(templates: dict[str, str], threshold: float) -> dict[str, tuple[list[str], int]]:
    """Label to distinct words and the number of them that a block must hold."""
    import re

    sets = {label: sorted({w for w in re.split(BREAK, text.lower()) if w}) for label, text in templates.items()}
    return {label: (words, max(1, math.ceil(threshold * len(words) - 1e-9))) for label, words in sets.items() if words}


def template_spans(templates: dict[str, str]) -> dict[str, int]:
    """Label to the number of words of a run that is whole in one window of its template."""
    import re

    counts = {label: sum(1 for w in re.split(BREAK, text.lower()) if w) for label, text in templates.items()}
    return {label: math.ceil(SLACK * n) for label, n in counts.items() if n}


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _windows(span: int, vocabulary: list[str]) -> Column:
    """Template words of windows of two spans, one from each span on."""
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size("words"), F.lit(1)) - 1) / span).cast("int"))
    return F.transform(starts, lambda k: F.struct(F.lit(span).alias("span"), F.array_intersect(
        F.slice(F.col("words"), k * span + 1, 2 * span), _literal(vocabulary)).alias("words")))


def _at_least(need: int):
    return lambda block: F.size(block["words"]) >= need


def _places(words: Column, phrase: tuple[str, ...]) -> Column:
    """The starts of a phrase; texts without its last word are not searched."""
    none = F.array().cast("array<int>")

    def here(i: Column) -> Column:
        found = F.lit(True)
        for k, word in enumerate(phrase):
            found = found & (F.get(words, i + k) == word)
        return F.coalesce(found, F.lit(False))

    held = F.lit(True)
    for word in phrase:
        held = held & F.array_contains(words, word)
    return F.when(held, F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)).otherwise(none)


def scan_licenses(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, templates: dict[str, str] | None = None,
    threshold: float = 0.9, block_lines: int = 3,
) -> DataFrame:
    """One row per input row: id, word and phrase counts, ``base_labels``, ``matches`` (label and containment)."""
    given = TEMPLATES | WHOLE if templates is None else templates
    sets, spans = template_sets(given, threshold), template_spans(given)
    vocabulary = sorted({w for words, _ in sets.values() for w in words})
    least = min(need for _, need in sets.values())
    df = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"),
                     lowered(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    df = df.withColumn("words", words_of(F.col("t")))
    df = df.withColumn("known", F.array_intersect("words", _literal(vocabulary)))
    for label, phrase in PHRASES.items():
        df = df.withColumn(label, _places(F.col("words"), phrase))
    # what the whole text does not contain, no block of it contains
    none = F.array().cast("array<struct<span:int,words:array<string>>>")
    may, windows = F.lit(False), []
    for span in sorted(set(spans.values())):
        held, need_here = F.lit(False), min(sets[label][1] for label in sets if spans[label] == span)
        for label, (words, need) in sets.items():
            if spans[label] == span:
                held = held | (F.size(F.array_intersect("known", _literal(words))) >= need)
        may = may | held
        windows.append(F.when(held, F.filter(_windows(span, vocabulary), _at_least(need_here))).otherwise(none))
    lines = F.transform(F.split("t", "\n"), lambda x: F.array_intersect(words_of(x), _literal(vocabulary)))
    df = df.withColumn("lines", F.when(may, lines).otherwise(F.array().cast("array<array<string>>")))
    by_line = F.transform("lines", lambda x, i: F.struct(
        F.lit(0).alias("span"), F.array_distinct(F.flatten(F.slice(F.col("lines"), i + 1, block_lines))).alias("words")))
    blocks = F.concat(F.filter(by_line, _at_least(least)), *windows)
    found = F.concat(*[F.col(label) for label in PHRASES])
    parts = stored(df.select(
        "row", "id", F.size("words").cast("long").alias("n_words"), F.size(found).cast("long").alias("n_base"),
        F.array_min(found).cast("long").alias("first_word"), F.array_max(found).cast("long").alias("last_word"),
        F.sort_array(F.array_compact(F.array(*[F.when(F.size(label) > 0, F.lit(label)) for label in PHRASES]))).alias("base_labels"),
        "known", blocks.alias("blocks"),
    ), "licenses")
    met = blocks_meeting(parts, sets, spans, vocabulary, least)
    per_row = met.groupBy("row").agg(
        F.sort_array(F.collect_set("label")).alias("template_labels"), F.max("containment").alias("containment"),
        F.count_distinct("block").alias("n_blocks"))
    return parts.drop("known", "blocks").join(per_row, "row", "left").select(
        F.col("id").alias(id), "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.coalesce("template_labels", F.array().cast("array<string>")).alias("template_labels"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"), F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))


def word_order(parts: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template words, rarest in the corpus first; one count for each word reaches the driver."""
    counted = parts.select(F.explode("known").alias("word")).groupBy("word").count().collect()
    held = {r["word"]: r["count"] for r in counted}
    return sorted(vocabulary, key=lambda w: (held.get(w, 0), w))


def blocks_meeting(
    parts: DataFrame, sets: dict[str, tuple[list[str], int]], spans: dict[str, int], vocabulary: list[str], least: int,
) -> DataFrame:
    """(row, block, label, containment) of every block that meets a template."""
    place = {w: i for i, w in enumerate(word_order(parts, vocabulary))}
    prefixes = []
    for label, (words, need) in sets.items():
        ordered = sorted(words, key=place.__getitem__)
        prefixes += [(w, span, label, i, need, words) for i, w in enumerate(ordered[:len(words) - need + 1]) for span in (0, spans[label])]
    side = parts.sparkSession.createDataFrame(
        prefixes, "word string, span int, label string, i int, need int, template array<string>")
    rank = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])
    ordered = F.transform(
        F.sort_array(F.transform("block", lambda w: F.struct(F.element_at(rank, w).alias("p"), w.alias("w")))), lambda x: x["w"])
    block = parts.select("row", F.posexplode("blocks").alias("b", "held")).select(
        "row", "b", F.col("held.span").alias("span"), F.col("held.words").alias("block")).withColumn("block", ordered)
    probe = block.select("row", "b", "span", "block", F.posexplode(
        F.slice("block", 1, F.size("block") - F.lit(least) + 1)).alias("j", "word"))
    near = probe.join(F.broadcast(side), ["word", "span"]).where(
        (F.size("block") >= F.col("need"))
        & (1 + F.least(F.size("template") - 1 - F.col("i"), F.size("block") - 1 - F.col("j")) >= F.col("need")))
    shared = F.size(F.array_intersect("template", "block"))
    return near.where(shared >= F.col("need")).select(
        "row", F.col("b").alias("block"), "label", (shared / F.size("template")).alias("containment"))
