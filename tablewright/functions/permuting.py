"""Keyed permutations of 0 .. size-1 as column expressions: every number gets another place, and none can be read off another.

A number is a pair of digits in a mixed base of ``a`` and ``b``. In each round one digit is moved by a keyed hash of the other, which
can be undone, so the whole is one to one on ``a * b`` numbers. ``a * b`` exceeds ``size`` by a few numbers only; a number that
lands on one of those is sent through again. Each of them can be met once at most, so as many repeats as there are always suffice.
"""

from __future__ import annotations

from functools import lru_cache
from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.hashing import SEED, hash_hex

ROUNDS = 6
LARGEST = 1 << 60


@lru_cache
def bases(size: int, spare: int = 4) -> tuple[int, int]:
    """Two bases, as even as can be found, whose product is ``size`` or up to ``spare`` more."""
    root = isqrt(size)
    for top in (root, round(size ** (1 / 3)), min(1000, size)):
        for a in range(top, max(1, top - 500_000), -1):
            if -size % a <= spare:
                return a, -(-size // a)
    return 1, size


def _draw(label: str, value: Column, turn: Column, seed: str) -> Column:
    """A whole number of 60 bits."""
    text = F.concat_ws("|", value.cast("string"), turn.cast("string"))
    return F.conv(F.substring(hash_hex(label, text, 0, seed), 1, 15), 16, 10).cast("bigint")


def permuted(number: Column, size: int, label: str, seed: str = SEED) -> Column:
    """The place of ``number`` (0 .. size-1) in the order that ``label`` and ``seed`` give."""
    if not 0 < size <= LARGEST:
        raise ValueError(f"a permutation needs between 1 and {LARGEST} numbers")
    a, b = bases(size)

    def turn(pair: Column, i: Column) -> Column:
        """Odd rounds move the first digit, even ones the second."""
        high, low = pair["high"], pair["low"]
        moved = F.when(i % 2 == 1, (high + _draw(label, low, i, seed) % F.lit(a)) % F.lit(a)).otherwise(high)
        shifted = F.when(i % 2 == 0, (low + _draw(label, high, i, seed) % F.lit(b)) % F.lit(b)).otherwise(low)
        return F.struct(moved.alias("high"), shifted.alias("low"))

    def once(x: Column) -> Column:
        start = F.struct(F.call_function("div", x, F.lit(b).cast("bigint")).alias("high"), (x % F.lit(b)).cast("bigint").alias("low"))
        done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
        return done["high"] * F.lit(b) + done["low"]

    out = once(number.cast("bigint"))
    if a * b > size:
        out = F.aggregate(F.sequence(F.lit(1), F.lit(a * b - size)), out, lambda x, _: F.when(x < size, x).otherwise(once(x)))
    return out
