"""Turning values into the types that a target asks for."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.types import spark_type, standard_name

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def null_token(column: Column, token: str = "null") -> Column:
    """Text that spells the token, in any case, reads as NULL."""
    return F.when(F.lower(column) != token.lower(), column)


def from_text(column: Column, type_name: str, null_text: bool = True) -> Column:
    """Text to the Spark type behind a warehouse type name; a bad value fails the job."""
    value = null_token(column) if null_text else column
    return value.cast(spark_type(type_name))


def entity_id(column: Column, type_name: str) -> Column:
    """Cast a root key to its declared storage class; other classes leave it alone."""
    # Storage classes of a root key.
    targets = {
        "INTEGER": "bigint",
        "REAL": "double",
        "DATETIME": "timestamp_ntz",
        "DATE": "timestamp_ntz",
        "TIME": "timestamp_ntz",
        "BLOB": "binary",
        "TEXT": "string",
    }
    target = targets.get(type_name.upper())
    return column.cast(target) if target else column


def decimal_class(dtype: T.DecimalType) -> str:
    return "NUMERIC" if dtype.scale <= 9 else "BIGNUMERIC"


def plain_decimal(column: Column) -> Column:
    """A decimal as text without an exponent."""
    return column.cast("string")


def json_text(column: Column, dtype: T.DataType) -> Column:
    """JSON text of a value; text is taken to be JSON already."""
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(column)
    wrapped = F.to_json(F.struct(column.alias("v")))
    return F.when(column.isNotNull(), F.regexp_extract(wrapped, r'^\{"v":(.*)\}$', 1))


def _require(ok: bool, wanted: str, dtype: T.DataType) -> None:
    if not ok:
        raise TypeError(f"expected a value for {wanted} but the column is {dtype.simpleString()}")


def write_value(column: Column, dtype: T.DataType, type_name: str) -> Column:
    """The form in which a value is handed to a column of the named type."""
    name = standard_name(type_name)
    text = isinstance(dtype, T.StringType)
    number = isinstance(dtype, T.NumericType)
    if name in ("STRING", "GEOGRAPHY"):
        return column.cast("string")
    if name == "INT64":
        _require(number, name, dtype)
        return column.cast("bigint")
    if name == "FLOAT64":
        _require(number, name, dtype)
        return column.cast("double")
    if name in ("NUMERIC", "BIGNUMERIC"):
        _require(number, name, dtype)
        if isinstance(dtype, T.DecimalType) and dtype.scale > 9:
            return plain_decimal(column)
        return column
    if name == "BOOL":
        return column.cast("boolean")
    if name == "BYTES":
        return F.base64(column.cast("binary"))
    if name == "DATE":
        _require(text or isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)), name, dtype)
        return column if text else date_text(column)
    if name == "TIME":
        _require(text or isinstance(dtype, (T.TimestampType, T.TimestampNTZType)), name, dtype)
        return column if text else time_text(column, dtype)
    if name in ("DATETIME", "TIMESTAMP"):
        _require(text or isinstance(dtype, (T.TimestampType, T.TimestampNTZType)), name, dtype)
        return column if text else datetime_text(column, dtype)
    if name == "JSON":
        return json_text(column, dtype)
    if name in ("INTERVAL", "RANGE"):
        return column
    raise ValueError(f"unsupported type: {type_name}")


def datetime_text(column: Column, dtype: T.DataType) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS``; a zoneless value never passes through the session's zone."""
    if not isinstance(dtype, T.TimestampNTZType):
        return F.date_format(column, DATETIME_FORMAT)
    text = column.cast("string")
    return F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 26, "0")


def time_text(column: Column, dtype: T.DataType) -> Column:
    """``HH:mm:ss.SSSSSS`` of a date-time."""
    return F.substring(datetime_text(column, dtype), 12, 15)


def date_text(column: Column) -> Column:
    return column.cast("date").cast("string")


def micros(column: Column) -> Column:
    """Microseconds since 1970 of a zoneless date-time."""
    span = column - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    part = lambda unit: F.extract(F.lit(unit), span)
    minutes = (part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes.cast("bigint") * F.lit(60_000_000) + (part("SECOND") * F.lit(1_000_000)).cast("bigint")


def from_epoch_days(column: Column) -> Column:
    return F.date_from_unix_date(column.cast("int"))


def from_epoch_micros(column: Column) -> Column:
    """A zoneless date-time from microseconds since 1970, all six digits kept."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (column.cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    )


def time_of_micros(column: Column) -> Column:
    """``HH:mm:ss.SSSSSS`` from microseconds since midnight."""
    return time_text(from_epoch_micros(column), T.TimestampNTZType())


def interval_text(months: Column, days: Column, hours: Column, minutes: Column, seconds: Column) -> Column:
    """``+Y-M +D +H:M:S.SSS``; the time sign is that of the whole time part."""
    sign = lambda c: F.when(c >= 0, "+").otherwise("-")
    whole = F.abs(months)
    clock = hours * 3600 + minutes * 60 + seconds
    return F.format_string(
        "%s%d-%d %s%d %s%d:%d:%.3f",
        sign(months), F.floor(whole / 12).cast("bigint"), (whole % 12).cast("bigint"),
        sign(days), F.abs(days).cast("bigint"),
        sign(clock), F.abs(hours).cast("bigint"), F.abs(minutes).cast("bigint"), F.abs(seconds).cast("double"),
    )


def range_bounds(column: Column) -> Column:
    """A start/end record as a two-element array."""
    return F.array(column["start"], column["end"])


def fit(column: Column, have: T.DataType, want: T.DataType, path: str, cast: Callable[[Column, T.DataType], Column]) -> Column:
    """Shape a value like ``want``: records by field name, arrays per element, maps per key and value.

    A missing sub-field becomes NULL and a surplus one is dropped. Where ``cast`` is lenient, a map entry whose key does not fit
    is left out, as no map has a null key; of keys that become equal the last one stays.
    """
    if isinstance(want, T.StructType):
        if not isinstance(have, T.StructType):
            raise TypeError(f"{path}: expected a record, found {have.simpleString()}")
        given = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            source = given.get(f.name.lower())
            value = (
                fit(column.getField(source.name), source.dataType, f.dataType, f"{path}.{f.name}", cast)
                if source
                else F.lit(None).cast(f.dataType)
            )
            parts.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType):
        if not isinstance(have, T.ArrayType):
            raise TypeError(f"{path}: expected an array, found {have.simpleString()}")
        return F.transform(column, lambda v: fit(v, have.elementType, want.elementType, f"{path}[]", cast))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType) and have != want:
        key = lambda k: fit(k, have.keyType, want.keyType, f"{path}.key", cast)
        value = lambda v: fit(v, have.valueType, want.valueType, f"{path}.value", cast)
        if have.keyType == want.keyType:
            return F.transform_values(column, lambda k, v: value(v))
        pairs = F.transform(F.map_entries(column), lambda e: F.struct(key(e["key"]).alias("key"), value(e["value"]).alias("value")))
        pairs = F.filter(pairs, lambda e: e["key"].isNotNull())
        last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["key"] == e["key"]))
        return F.map_from_entries(last)
    if isinstance(have, (T.StructType, T.ArrayType)) and isinstance(want, T.StringType):
        return F.to_json(column)
    return column if have == want else cast(column, want)


def strict(column: Column, want: T.DataType) -> Column:
    return column.cast(want)


def lenient(column: Column, want: T.DataType) -> Column:
    return column.try_cast(want)


def fit_to_schema(df: DataFrame, target: T.StructType, cast: Callable = strict) -> DataFrame:
    """Columns of ``df`` cast to the target's types and order.

    A column the target does not know is an error; one it lacks becomes NULL.
    """
    wanted = {f.name.lower() for f in target.fields}
    surplus = [c for c in df.columns if c.lower() not in wanted]
    if surplus:
        raise ValueError(f"columns not in the target: {', '.join(surplus)}")
    given = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in target.fields:
        source = given.get(f.name.lower())
        value = (
            fit(F.col(f"`{source.name}`"), source.dataType, f.dataType, f.name, cast)
            if source
            else F.lit(None).cast(f.dataType)
        )
        out.append(value.alias(f.name))
    return df.select(*out)


def merge_records(df: DataFrame, layers: Sequence[Mapping[str, Column]], ignore_case: bool = False) -> DataFrame:
    """One record from several name->value layers; a later layer wins, nulls included."""
    merged: dict[str, tuple[str, Column]] = {}
    for layer in layers:
        for name, value in layer.items():
            key = name.lower() if ignore_case else name
            shown = merged[key][0] if key in merged else name
            merged[key] = (shown, value)
    return df.select(*[value.alias(name) for name, value in merged.values()])
