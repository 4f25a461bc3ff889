"""Row filters with bound values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tablewright.functions.types import source_type, spark_type


# Quoted text (with backslash escapes), quoted names, or a bare mark.
_QUOTED_OR_MARK = re.compile(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`|\?""", re.S)


def pieces(where: str) -> list[str]:
    """The filter text cut at its ``?`` marks; marks inside quotes are plain text."""
    parts, start = [], 0
    for found in _QUOTED_OR_MARK.finditer(where):
        if found.group() == "?":
            parts.append(where[start:found.start()])
            start = found.end()
    return [*parts, where[start:]]


def typed_filter(df: DataFrame, where: str, params: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Rows for which ``where`` holds; each ``?`` is bound to (column, text) in turn.

    The text is cast to the type of that column, and the number of marks must
    equal the number of values. Values are bound, never spliced, so quotes,
    dollars and backslashes in them are plain characters. The casts fold to
    literals before planning, so the filter still reaches the file reader.
    """
    parts = pieces(where)
    if len(parts) - 1 > len(params):
        raise ValueError("not enough values for the ? marks")
    if len(parts) - 1 < len(params):
        raise ValueError("too many values for the ? marks")
    if not params:
        return df.where(where) if where.strip() else df
    types = {f.name.lower(): spark_type(source_type(f.dataType)) for f in df.schema.fields}
    bound = "".join(
        part + (f"CAST(? AS {types[params[i][0].lower()]})" if i < len(params) else "") for i, part in enumerate(parts)
    )
    values = [None if text is None or text.lower() == "null" else text for _, text in params]
    bound = bound.replace("{", "{{").replace("}", "}}")  # braces would name frames
    return df.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {bound}", args=values, rows=df)


def flag(column: Column) -> Column:
    """Run flags come as text or numbers."""
    return column.cast("boolean")
