"""Line-first cleaning (native): judge each line, drop the failing ones, then reject texts that lost too much.

A line fails by one of three rules:

* punctuation: a short line without any sentence mark, or a line where marks or symbols in runs
  (``!!``, ``***``) follow too many of its words, or half of the words repeat the word before;
* navigation: items held apart by bars, bullets or arrows instead of sentences;
* boilerplate: a fixed phrase of site furniture in a line of moderate length.

Lines without a word are neither judged nor counted. A document is rejected if the lines that
stay hold less than ``min_kept_share`` of the characters of its judged lines, or if the base
rules on the whole text fail (too few words, too many words inside repeated windows).

Everything is column expressions on one row: no shuffle, so no key can be hot, and the work of a
row is linear in its text (n log n where windows repeat).

Defined results: null and empty texts have no words, fail the base rules and are not kept; equal
rows get equal verdicts; an empty table gives an empty table; further columns pass through, whatever
their names, and only a column called like ``into`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import quoted, unused

#: White space of the word rule.
BLANKS = " \t\n\x0b\f\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Fixed phrases of site furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "accept cookies",
    "enable javascript", "click here", "sign up for", "subscribe to our", "follow us on", "lorem ipsum",
)
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPLIT), "")


def _stripped(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(words: Column, window: int) -> Column:
    """Words that lie in a window found twice or more; ``words`` holds one hash per word."""
    size = F.size(words)
    starts = F.when(size >= window, F.sequence(F.lit(0), size - window)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))


def _covered(words: Column, hashes: Column, window: int) -> Column:
    """Adds a second hash to each window, sorts, and measures the union of the windows that have an equal."""
    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(
        h.alias("h"), F.xxhash64(F.lit(7), *[F.get(words, i + k) for k in range(window)]).alias("g"), i.alias("i"))))

    def positions(s: Column) -> Column:
        def equal(x: Column, j: Column) -> Column:
            y = F.get(s, j)
            return F.coalesce((x["h"] == y["h"]) & (x["g"] == y["g"]), F.lit(False))

        return F.sort_array(F.transform(F.filter(s, lambda x, j: equal(x, j - 1) | equal(x, j + 1)), lambda x: x["i"]))

    def measured(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    # transform over a one-element array binds a value once, where a plain reference would repeat its expression
    at = F.get(F.transform(F.array(keyed), positions), F.lit(0))
    return F.get(F.transform(F.array(at), measured), F.lit(0))


RUNS, BARS = "[!?#*$%&~^=_<>]{2,}", "|»«•›‹→"


def _same_as_before(words: Column) -> Column:
    """How many words equal the word before them; the array is bound once."""
    return F.get(F.transform(F.array(words), lambda w: F.size(
        F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False))))), F.lit(0))


def _close_repeats(words: Column) -> Column:
    """Whether two words that equal the word before them are neighbours or have one word between: ``a a a``, ``a a b b``."""
    def close(w: Column) -> Column:
        return F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False)) & (
            (x == F.get(w, i + 1)) | (F.get(w, i + 1) == F.get(w, i + 2))))) > 0

    return F.get(F.transform(F.array(words), close), F.lit(0))


def _signs(text: Column, hashed: Column) -> Column:
    """What a whole text holds of the signs that the dearer line rules look for; most texts hold none.

    Each is necessary for its rule, so a line is judged alike in every text: where half of four or more words repeat the
    word before, two of these repeats are at most two words apart.
    """
    lower = F.lower(text)
    furniture = F.lit(False)
    for phrase in BOILERPLATE:
        furniture = furniture | lower.contains(phrase)
    return F.struct(
        text.rlike(RUNS).alias("runs"), (F.length(_stripped(text, BARS)) < F.length(text)).alias("bars"),
        furniture.alias("furniture"), _close_repeats(hashed).alias("stutter"),
    )


def line_fails(line: Column, signs: Column, min_words: int, run_share: float) -> Column:
    """True if a line with words breaks a rule."""
    words = F.size(words_of(line))
    enough = f"([^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]+){{{min_words - 1}}}[^\\x20\\x09-\\x0D]"
    lower, runs = F.lower(line), F.size(F.split(line, RUNS)) - 1
    bars = F.length(line) - F.length(_stripped(line, BARS))
    short = ~line.rlike(enough) & ~line.rlike("[.!?:;…。！？]")
    furniture = F.lit(False)
    for phrase in BOILERPLATE:
        furniture = furniture | lower.contains(phrase)
    return (
        short | (signs["runs"] & (runs >= 3) & (runs >= run_share * words))
        | (signs["bars"] & (bars >= 3) & (4 * bars >= words)) | (signs["furniture"] & furniture & (words <= 40))
        | (signs["stutter"] & (words >= 4) & (2 * _same_as_before(words_of(line)) >= words))
    )


def quality_rules(
    docs: DataFrame, text: str = "text", into: str = "quality", *, min_words: int = 20, max_repeat_share: int = 30,
    min_line_words: int = 5, run_share: float = 0.3, min_kept_share: float = 0.5,
) -> DataFrame:
    """The rows with a struct ``into``: the counts, ``base_failed``, ``kept`` and the cleaned ``text``."""
    stem = "__q_"
    while any(c.lower().startswith(stem) for c in docs.columns):
        stem += "_"
    t, made = stem + "text", stem + "%s"
    df = docs.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn(made % "words", words_of(F.col(t))).withColumn(made % "lines", F.split(F.col(t), "\n"))
    df = df.withColumn(made % "real", F.filter(F.col(made % "lines"), lambda x: F.length(_stripped(x, BLANKS)) > 0))
    df = df.withColumn(made % "n", F.size(made % "words").cast("long"))
    df = df.withColumn(made % "hashed", F.transform(made % "words", lambda w: F.xxhash64(w)))
    df = df.withColumn(made % "windows", _repeated(F.col(made % "hashed"), WINDOW))
    df = df.withColumn(made % "repeat", F.when(
        F.size(F.array_distinct(made % "windows")) < F.size(made % "windows"),
        _covered(F.col(made % "hashed"), F.col(made % "windows"), WINDOW)).otherwise(F.lit(0).cast("long")))
    df = df.withColumn(made % "signs", _signs(F.col(t), F.col(made % "hashed")))
    signs = F.col(made % "signs")
    df = df.withColumn(made % "bad", F.transform(made % "lines", lambda x: (
        F.length(_stripped(x, BLANKS)) > 0) & line_fails(x, signs, min_line_words, run_share)))
    df = df.withColumn(made % "stay", F.filter(made % "lines", lambda x, i: ~F.get(F.col(made % "bad"), i)))

    df = df.withColumn(made % "all_chars", F.length(_stripped(F.col(t), BLANKS)).cast("long"))
    df = df.withColumn(made % "stay_chars", F.when(F.size(made % "stay") == F.size(made % "lines"), F.col(made % "all_chars"))
                       .otherwise(F.length(_stripped(F.array_join(made % "stay", ""), BLANKS)).cast("long")))
    n, repeat = F.col(made % "n"), F.col(made % "repeat")
    failed = (n < min_words) | (100 * repeat > max_repeat_share * n)
    enough = F.col(made % "stay_chars") >= min_kept_share * F.col(made % "all_chars")
    df = df.withColumn(into, F.struct(
        n.alias("n_words"), F.col(made % "all_chars").alias("word_chars"),
        (F.length(t) - F.length(_stripped(F.col(t), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(made % "real") - F.size(F.array_distinct(made % "real"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"), failed.alias("base_failed"), (~failed & enough).alias("kept"),
        F.size(F.filter(made % "bad", lambda x: x)).cast("long").alias("n_lines_removed"),
        F.col(made % "stay_chars").alias("kept_chars"), F.array_join(made % "stay", "\n").alias("text"),
    ))
    return df.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() != into.lower()], into)


def kept_only(judged: DataFrame, into: str = "quality") -> DataFrame:
    """The rows that stay. The row number holds the filter above the rules: pushed below, it would repeat them all."""
    row = unused(judged, "__q_row")
    return judged.withColumn(row, F.monotonically_increasing_id()).where(F.col(into)["kept"] & (F.col(row) >= 0)).drop(row)
