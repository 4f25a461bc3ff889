"""Iterative proportional fitting of token weights to source, language and topic shares, and sampling by them.

Tokens are summed per cell (source, language, topic), once. The expected tokens of the cells are then scaled to the
target shares of one margin after the other, with the bound inside: a cell never has more than its tokens, so the
shares hold for the sample itself and not only for weights. A document's probability is the expected share of its
cell's tokens. Each document draws a number from the hash of its id, so the sample does not depend on partitions or retries.

``budget_share`` of all tokens is what the sample may hold. Where the targets cannot be met with so many, because a value
has too few tokens or too few together with others, the sample gets smaller: the share is lowered (by ``halvings`` steps
of halving an interval) until all margins fit. Only targets that no weights meet, as values occur together in too few
cells, are missed; ``reached`` lists the shares that a sample has.

The cells are the only thing iterated over. Up to ``most_cells`` of them (counted first) are fitted in
memory; beyond that the same steps run as grouped sums over the cell table, each round written to the
shared folder. Documents meet their cell by a join on three columns in which they are the side
that the skew split cuts, so a hot source is no hot task.

Defined results: null values of a margin are a category of their own; a null or empty text has no tokens, takes
the weight of its cell and can be drawn; documents of a cell without tokens get probability 1; repeated rows
draw the same number; an empty table gives an empty table; the input columns stay, and only columns
called like the new ones are replaced. Without given targets a margin's shares are flattened by ``temper``;
targets for values that do not occur are left out and the others scaled to sum to one.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import quoted, stored, unused

MARGINS = ("m_source", "m_lang", "m_topic")
MOST = 1e300  # no factor grows beyond it, where a value has no tokens left to give


def n_tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")).cast("long")


def form_of(text: Column) -> Column:
    """A topic where the table has none: the form of the text."""
    words, t = n_tokens(text), F.coalesce(text, F.lit(""))
    bars = F.length(t) - F.length(F.translate(t, "|", ""))
    return F.when(bars * 4 >= words, "table").when(words < 100, "note").when(words < 1000, "article").otherwise("long")


def _shares(weights: np.ndarray, codes: np.ndarray, values: np.ndarray, given: Mapping[str, float] | None, temper: float) -> np.ndarray:
    held = np.bincount(codes, weights, len(values))
    goal = np.array([given.get(v, 0.0) for v in values]) if given is not None else (held / held.sum()) ** temper
    goal = np.where(held > 0, goal, 0)
    return goal / goal.sum()


def _largest(fit, highest: float, safe: float, halvings: int):
    """What ``fit`` gives for the largest share that fits; ``fit`` returns a result and whether all margins hold."""
    best, holds = fit(highest)
    if holds or safe >= highest:
        return best
    best, _ = fit(safe)
    low, high = safe, highest
    for _ in range(halvings):
        mid = (low + high) / 2
        result, holds = fit(mid)
        if holds:
            best, low = result, mid
        else:
            high = mid
    return best


def fit_in_memory(cells: list, targets: Mapping, temper: float, rounds: int, tolerance: float, budget_share: float, halvings: int = 12):
    """Weight per token and probability of each cell; ``cells`` are rows (three margins, tokens)."""
    tokens = np.array([c["tokens"] for c in cells], float)
    coded = [np.unique([c[m] for c in cells], return_inverse=True) for m in MARGINS]
    goals = [_shares(tokens, codes, values, targets.get(m), temper) for m, (values, codes) in zip(MARGINS, coded)]
    total = tokens.sum()

    def rake(share: float, bound: np.ndarray):
        x, off = tokens * share, 0.0
        for _ in range(rounds):
            off = 0.0
            for (values, codes), goal in zip(coded, goals):
                now = np.bincount(codes, np.minimum(x, bound), len(values)) / (total * share)
                off = max(off, float(np.abs(now - goal).max()))
                x = np.minimum(x * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[codes], MOST)
            if off < tolerance:
                break
        return np.minimum(x, bound), off < tolerance

    free, _ = rake(1.0, np.full(len(tokens), MOST))
    per_token = np.divide(free, tokens, out=np.ones_like(free), where=tokens > 0)
    room = [float((np.bincount(codes, tokens, len(values))[goal > 0] / (total * goal[goal > 0])).min()) for (values, codes), goal in zip(coded, goals)]
    w = _largest(lambda share: rake(share, tokens), min(budget_share, *room), min(budget_share, 1 / per_token.max()), halvings)
    p = np.divide(w, tokens, out=np.ones_like(w), where=tokens > 0)
    return np.where(tokens > 0, p * total / w.sum(), 1.0), p


def fit_distributed(
    cells: DataFrame, targets: Mapping, temper: float, rounds: int, tolerance: float, budget_share: float, halvings: int = 12,
) -> DataFrame:
    """The same over a cell table of any size."""
    total = float(cells.agg(F.sum("tokens")).first()[0])
    goals, room = {}, []
    for m in MARGINS:
        held = cells.groupBy(m).agg(F.sum("tokens").alias("held")).where("held > 0")
        if targets.get(m) is None:
            goal = held.select(m, "held", F.pow(F.col("held") / total, F.lit(temper)).alias("goal"))
        else:
            given = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in targets[m].items()], f"{m} string, goal double")
            goal = held.join(given, m, "left").select(m, "held", F.coalesce("goal", F.lit(0.0)).alias("goal"))
        sum_ = float(goal.agg(F.sum("goal")).first()[0])
        goals[m] = stored(goal.select(m, "held", (F.col("goal") / sum_).alias("goal")), "goals")
        room.append(float(goals[m].where("goal > 0").agg(F.min(F.col("held") / (total * F.col("goal")))).first()[0]))

    def rake(share: float, bounded: bool):
        bound = F.col("tokens").cast("double") if bounded else F.lit(MOST)
        x, off = cells.withColumn("x", F.col("tokens") * F.lit(share)), 0.0
        for _ in range(rounds):
            offs = []
            for m in MARGINS:
                now = x.groupBy(m).agg((F.sum(F.least("x", bound)) / (total * share)).alias("now")).join(
                    goals[m].drop("held"), m, "left").withColumn("goal", F.coalesce("goal", F.lit(0.0)))
                scale = F.when(F.col("now") > 0, F.col("goal") / F.col("now")).otherwise(0.0)
                x = x.join(now.select(m, scale.alias("scale"), F.abs(F.col("now") - F.col("goal")).alias(f"off_{m}")), m).withColumn(
                    "x", F.least(F.col("x") * F.col("scale"), F.lit(MOST))).drop("scale")
                offs.append(f"off_{m}")
            x = stored(x, "weights")
            off = x.agg(F.max(F.greatest(*offs))).first()[0]
            x = x.drop(*offs)
            if off < tolerance:
                break
        return x.withColumn("w", F.least("x", bound)).drop("x"), off < tolerance

    free, _ = rake(1.0, False)
    most = float(free.where("tokens > 0").agg(F.max(F.col("w") / F.col("tokens"))).first()[0])
    w = _largest(lambda share: rake(share, True), min(budget_share, *room), min(budget_share, 1 / most), halvings)
    drawn = float(w.agg(F.sum("w")).first()[0])
    p = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(1.0)
    return w.select(*MARGINS, F.when(F.col("tokens") > 0, p * F.lit(total / drawn)).otherwise(1.0).alias("per_token"), p.alias("probability"))


def draw(id: Column, seed: str) -> Column:
    """A number from 0 up to 1 by the hash of seed and id."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, source: Column | None = None, lang: Column | None = None,
    topic: Column | None = None, targets: Mapping[str, Mapping[str, float]] | None = None, temper: float = 0.7,
    budget_share: float = 0.8, rounds: int = 500, tolerance: float = 1e-7, halvings: int = 12, seed: str = "mix", most_cells: int = 100_000,
) -> DataFrame:
    """The rows with n_tokens, weight (per token), probability and sampled.

    ``targets`` maps ``m_source``, ``m_lang`` or ``m_topic`` to shares by value.
    """
    parts = [F.col("source") if source is None else source, F.col("lang") if lang is None else lang,
             form_of(F.col(text)) if topic is None else topic]
    made = ("n_tokens", "weight", "probability", "sampled")
    inner = [unused(docs, m) for m in MARGINS]
    tagged = docs.select(
        *[F.col(quoted(c)) for c in docs.columns if c.lower() not in made],
        *[F.coalesce(p.cast("string"), F.lit("\0null")).alias(c) for p, c in zip(parts, inner)], n_tokens(F.col(text)).alias("n_tokens"))
    cells = stored(tagged.groupBy(*[F.col(quoted(c)).alias(m) for c, m in zip(inner, MARGINS)]).agg(F.sum("n_tokens").alias("tokens")), "cells")
    schema = ", ".join(f"{m} string" for m in MARGINS) + ", per_token double, probability double"
    count, total = cells.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    options = (targets or {}, temper, rounds, tolerance, budget_share, halvings)
    if not total:
        fitted = cells.select(*MARGINS, F.lit(1.0).alias("per_token"), F.lit(1.0).alias("probability"))
    elif count <= most_cells:
        rows = cells.collect()
        per_token, p = fit_in_memory(rows, *options)
        fitted = cells.sparkSession.createDataFrame(
            [(*[r[m] for m in MARGINS], float(a), float(b)) for r, a, b in zip(rows, per_token, p)], schema)
    else:
        fitted = fit_distributed(cells, *options)
    fitted = fitted.select(*[F.col(m).alias(c) for m, c in zip(MARGINS, inner)], F.col("per_token").alias("weight"), "probability")
    out = tagged.join(fitted, inner).withColumn("sampled", draw(F.col(id), seed) < F.col("probability"))
    return out.drop(*inner).select(*[F.col(quoted(c)) for c in docs.columns if c.lower() not in made], *made)


def reached(mixed: DataFrame, **margins: Column) -> DataFrame:
    """(margin, value, held, expected, sampled): shares of the tokens of all rows, as expected of a sample, and of the sample drawn."""
    at = F.array(*[F.struct(F.lit(m).alias("margin"), c.cast("string").alias("value")) for m, c in margins.items()])
    n = F.col("n_tokens")
    sums = mixed.select(F.explode(at).alias("at"), n, (n * F.col("probability")).alias("p"), F.when(F.col("sampled"), n).otherwise(0).alias("s")).groupBy(
        "at").agg(F.sum("n_tokens").alias("n"), F.sum("p").alias("p"), F.sum("s").alias("s"))
    whole = mixed.agg(F.sum(n).alias("all_n"), F.sum(n * F.col("probability")).alias("all_p"), F.sum(F.when(F.col("sampled"), n).otherwise(0)).alias("all_s"))
    return sums.join(F.broadcast(whole)).select(
        "at.margin", "at.value", F.try_divide("n", "all_n").alias("held"), F.try_divide("p", "all_p").alias("expected"),
        F.try_divide("s", "all_s").cast("double").alias("sampled"))
