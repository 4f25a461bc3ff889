"""Made-up values as hash expressions, so a row gets the same values on every run and retry."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import patterns
from tablewright.functions.hashing import SEED, hash_hex, hash_letters, hash_number, hash_pick, hash_range
from tablewright.functions.types import source_type
from tablewright.operators.joins import children_of
from tablewright.operators.keys import dense_ids
from tablewright.rules.generators import BY_CLASS


def _digits(label: str, source: Column, draw: int, length: int, seed: str) -> Column:
    return F.lpad((hash_number(label, source, draw, seed) % F.lit(10**length)).cast("string"), length, "0")


def with_check_digit(digits: Column, length: int = 15) -> Column:
    """Append the mod-10 check digit to a text of ``length`` digits."""
    def weight(i: int) -> Column:
        digit = F.substring(digits, i + 1, 1).cast("int")
        if (length - i) % 2 == 0:
            return digit
        return F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    total = reduce(lambda a, b: a + b, [weight(i) for i in range(length)])
    return F.concat(digits, ((F.lit(10) - total % 10) % 10).cast("string"))


def _credit_card(label: str, source: Column, settings: Mapping, seed: str) -> Column:
    """Sixteen digits; the first ``prefix_length`` digits of the source are kept where it has them."""
    drawn = F.concat(_digits(label, source, 0, 8, seed), _digits(label, source, 1, 7, seed))
    kept = settings.get("prefix_length", 0)
    if kept:
        own = F.regexp_extract(source.cast("string"), rf"^(\d{{{kept}}})", 1)
        drawn = F.when(F.length(own) == kept, F.concat(own, F.substring(drawn, kept + 1, 15 - kept))).otherwise(drawn)
    return with_check_digit(drawn)


def _ssn(label: str, source: Column, settings: Mapping, seed: str) -> Column:
    part = lambda draw, high, width: F.lpad((F.lit(1) + hash_number(label, source, draw, seed) % high).cast("string"), width, "0")
    return F.concat_ws(settings.get("delimiter", "-"), part(0, 665, 3), part(1, 99, 2), part(2, 9999, 4))


GENERATE: dict[str, Callable[[str, Column, Mapping, str], Column]] = {
    "string": lambda label, source, s, seed: hash_letters(label, source, s["low"], s["high"], seed),
    "number": lambda label, source, s, seed: hash_range(label, source, 0, s["low"], s["high"], seed),
    "choice": lambda label, source, s, seed: hash_pick(label, source, s["items"], 0, seed),
    "pattern": lambda label, source, s, seed: patterns.drawn(s["pattern"], label, source, seed),
    "credit_card": _credit_card,
    "ssn": _ssn,
}


def generate(generator: str, settings: Mapping, label: str, source: Column, seed: str = SEED) -> Column:
    """The value that ``generator`` makes for ``source`` under the name ``label``."""
    return GENERATE[generator](label, source, settings, seed)


def generate_class(class_name: str, label: str, source: Column, seed: str = SEED) -> Column:
    """A value for a class, or NULL where the class has no generator."""
    if class_name not in BY_CLASS:
        return F.lit(None).cast("string")
    generator, settings, _, _ = BY_CLASS[class_name]
    return generate(generator, settings, label, source, seed)


def room_for(generator: str, settings: Mapping) -> int:
    """How many different values ``numbered_value`` has."""
    if generator == "number":
        return settings["high"] - settings["low"] + 1
    if generator == "string":
        return 16 ** settings["low"]
    if generator == "pattern":
        return patterns.size(settings["pattern"])
    if generator == "credit_card":
        return 10**15
    if generator == "ssn":
        return 665 * 99 * 9999
    raise ValueError(f"no unique form for {generator}")


def numbered_value(generator: str, settings: Mapping, number: Column) -> tuple[Column, int]:
    """The ``number``-th (from 1) of a generator's values, all different, and how many there are."""
    n, room = number - F.lit(1), room_for(generator, settings)
    if generator == "number":
        return F.lit(settings["low"]) + n, room
    if generator == "string":
        return F.translate(F.lpad(F.lower(F.hex(n)), settings["low"], "0"), "0123456789abcdef", "abcdefghijklmnop"), room
    if generator == "pattern":
        return patterns.numbered(settings["pattern"], n), room
    if generator == "credit_card":
        return with_check_digit(F.lpad(n.cast("string"), 15, "0")), room
    area = F.lpad((F.lit(1) + n % 665).cast("string"), 3, "0")
    group = F.lpad((F.lit(1) + F.floor(n / 665) % 99).cast("string"), 2, "0")
    serial = F.lpad((F.lit(1) + F.floor(n / (665 * 99))).cast("string"), 4, "0")
    return F.concat_ws(settings.get("delimiter", "-"), area, group, serial), room


def type_default(dtype: T.DataType, label: str, source: Column) -> Column:
    """A value for a column with no class, chosen by its type alone."""
    draw = hash_number(label, source, 0)
    name = source_type(dtype)
    if name == "INT64":
        return (draw % 1_000_000).cast(dtype)
    if name == "FLOAT64":
        return ((draw % 1_000_000) / F.lit(100.0)).cast(dtype)
    if name in ("NUMERIC", "BIGNUMERIC"):
        return (draw % 1000).cast(dtype)
    if name == "BOOL":
        return draw % 2 == 1
    if name == "DATE":
        return F.date_add(F.lit("2000-01-01").cast("date"), (draw % 9000).cast("int"))
    if name in ("DATETIME", "TIMESTAMP"):
        start = F.lit("2000-01-01 00:00:00").cast(dtype)
        return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (draw % 700_000_000).cast("decimal(18,6)"))
    if name == "BYTES":
        return F.unhex(hash_hex(label, source, 0))
    if name == "JSON":
        return F.lit(None).cast(dtype)
    if name == "STRING":
        return hash_letters(label, source, 5, 15)
    return F.lit(None).cast(dtype)


def generate_columns(
    df: DataFrame, source: Column, schema: T.StructType, classes: Mapping[str, str] | None = None
) -> DataFrame:
    """Add a made-up value for every column of ``schema`` that ``df`` does not have yet.

    Columns named in ``classes`` use their class's generator, the rest the
    default of their type. Columns already there (parent keys, sequences) win.
    """
    have = {c.lower() for c in df.columns}
    made = {}
    for f in schema.fields:
        if f.name.lower() in have:
            continue
        value = generate_class(classes[f.name], f.name, source) if classes and f.name in classes else None
        made[f.name] = value.cast(f.dataType) if value is not None else type_default(f.dataType, f.name, source)
    return df.withColumns(made) if made else df


def generate_children(
    parents: DataFrame, parent_fields: Mapping[str, str], count, schema: T.StructType,
    sequence: str | None = None, classes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Made-up child rows for every parent: its keys, a running id, and generated values."""
    rows = children_of(parents, parent_fields, count)
    keys = list(parent_fields.values())
    if sequence:
        rows = dense_ids(rows, [*keys, "child_no"], sequence)
    source = F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.col("child_no").cast("string"))
    return generate_columns(rows, source, schema, classes).select(*_order(rows.columns, schema))


def _order(first: Sequence[str], schema: T.StructType) -> list[str]:
    known = {c.lower() for c in first}
    return [*first, *[f.name for f in schema.fields if f.name.lower() not in known]]
