"""Turning one wide row of measures into one row per measured thing.

The records are written as SQL text: a wide table has thousands of small
expressions, and one text is far quicker to hand over than as many objects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(value: str) -> str:
    """A SQL literal for any text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def measure(text: str, name: str) -> Column:
    return F.expr(f"{text} AS {name}")


def long_form(wide: DataFrame, records: Sequence[Mapping[str, str]]) -> DataFrame:
    """One output row per record; a record maps column names to SQL text over the wide row."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"{quoted(name)}, {value}" for name, value in record.items()) + ")" for record in records
    )
    return wide.select(F.expr(f"inline(array({structs}))"))
