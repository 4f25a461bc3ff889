"""Repeatable picks: every draw is a hash of seed, name, id and draw number.

md5 is used because any SQL engine can repeat it, which keeps masked values
checkable outside Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = "42"


def hash_hex(name: str | Column, value: Column, draw: int, seed: str = SEED) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return F.md5(F.concat_ws("|", F.lit(seed), label, value.cast("string"), F.lit(str(draw))))


def hash_number(name: str | Column, value: Column, draw: int, seed: str = SEED) -> Column:
    """A whole number of 32 bits."""
    return F.conv(F.substring(hash_hex(name, value, draw, seed), 1, 8), 16, 10).cast("bigint")


def hash_range(name: str, value: Column, draw: int, low: int, high: int, seed: str = SEED) -> Column:
    return F.lit(low) + hash_number(name, value, draw, seed) % F.lit(high - low + 1)


def hash_letters(name: str, value: Column, low: int, high: int, seed: str = SEED) -> Column:
    """Lower-case letters, between ``low`` and ``high`` (at most 64) of them."""
    if high > 64:
        raise ValueError("at most 64 letters")
    letters = F.translate(
        F.concat(hash_hex(name, value, 1, seed), hash_hex(name, value, 2, seed)), "0123456789abcdef", "abcdefghijklmnop"
    )
    return F.substring(letters, F.lit(1), hash_range(name, value, 0, low, high, seed).cast("int"))


def hash_pick(name: str, value: Column, items: Sequence[str], draw: int = 0, seed: str = SEED) -> Column:
    options = F.array(*[F.lit(i) for i in items])
    place = (hash_number(name, value, draw, seed) % F.lit(len(items))).cast("int") + F.lit(1)
    return F.element_at(options, place)
