"""Measuring and classifying columns; each profile is one pass over its table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.records import long_form, measure, named, quoted
from tablewright.rules.generators import GENERATORS
from tablewright.rules.patterns import CLASS_THRESHOLD, DATA_PATTERNS, NAME_PATTERNS, PERSONAL_CLASSES

Pattern = tuple[str, str, float]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_percentages(df: DataFrame, table: str) -> DataFrame:
    """Share of nulls of every column."""
    names = df.columns
    aggs = [measure("count(1)", "n"), *[measure(f"count({named(c)})", f"c{i}") for i, c in enumerate(names)]]
    return long_form(df.agg(*aggs), [
        {"table_name": quoted(table), "column_name": quoted(c), "null_share": f"CASE WHEN n > 0 THEN (n - c{i}) / n END"}
        for i, c in enumerate(names)
    ])


def profile(df: DataFrame, table: str, exact_distinct: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, smallest and largest value (as text) of every scalar column.

    Distinct counts are estimates from the same pass. The exact form counts
    (column, value) pairs instead: values merge on the map side, and the column
    name alone is only grouped on afterwards, so no column lands in one task raw.
    Columns of one type go together, as values of that type.
    """
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    aggs = [measure("count(1)", "n")]
    for i, c in enumerate(names):
        aggs += [measure(f"count({named(c)})", f"c{i}"), measure(f"cast(min({named(c)}) AS STRING)", f"lo{i}"),
                 measure(f"cast(max({named(c)}) AS STRING)", f"hi{i}")]
        if not exact_distinct:
            aggs.append(measure(f"approx_count_distinct({named(c)})", f"d{i}"))
    measured = long_form(df.agg(*aggs), [
        {
            "table_name": quoted(table), "column_name": quoted(c), "row_count": "n", "null_count": f"n - c{i}",
            "min_value": f"lo{i}", "max_value": f"hi{i}", **({} if exact_distinct else {"distinct_count": f"d{i}"}),
        }
        for i, c in enumerate(names)
    ])
    if not exact_distinct:
        return measured
    kinds: dict[str, list[int]] = {}
    for i, c in enumerate(names):
        kinds.setdefault(_counted_as(df.schema[c].dataType), []).append(i)
    counts = []
    for kind, of in kinds.items():
        pairs = long_form(df.select(*[named(names[i]) for i in of]), [{"i": str(i), "v": f"cast({named(names[i])} AS {kind})"} for i in of])
        # floats tell the two zeros apart, as their texts do
        zero = [F.expr("v = 0 AND cast(v AS STRING) = '-0.0'").alias("below")] if kind == "double" else []
        values = pairs.where(F.col("v").isNotNull()).select("i", "v", *zero).groupBy("i", "v", *(["below"] if zero else [])).agg(F.lit(1).alias("one"))
        counts.append(values.groupBy("i").agg(F.count("*").alias("distinct_count")))
    label = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1).alias("column_name")
    distinct = reduce(DataFrame.unionByName, counts).select(label, "distinct_count") if counts else measured.select("column_name", F.lit(0).alias("distinct_count"))
    return measured.join(distinct, "column_name", "left").select(
        *measured.columns, F.coalesce("distinct_count", F.lit(0)).cast("bigint").alias("distinct_count")
    )


def _counted_as(kind: T.DataType) -> str:
    """The type in which distinct values are counted: one for all whole numbers, one for all floats, text where values have no plain form."""
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return "double"
    return kind.simpleString() if isinstance(kind, (T.BooleanType, T.DateType, T.TimestampNTZType)) else "string"


def _words(*words: str):
    return lambda c: "(" + " OR ".join(f"contains(lower({c}), {quoted(w.lower())})" for w in words) + ")"


# What a value must have before its pattern can match at all. These tests are
# plain scans, many times cheaper than the patterns they spare.
_DIGIT = lambda c: f"{c} RLIKE '[0-9]'"

NEEDED = {
    **dict.fromkeys(
        ("DATE_OF_BIRTH", "CREDIT_CARD", "DRIVER_LICENSE", "PASSPORT", "ZIP_CODE", "SOCIAL_SECURITY_NUMBER", "TELEPHONE_NUMBER"), _DIGIT
    ),
    "GENDER": _words("male"),
    "RACE_ETHNICITY": _words("white", "black", "african american", "american indian", "alaska native", "asian", "hawaiian"),
    "RELIGION": _words(
        "christian", "catholic", "jehovah's witness", "jewish", "muslim", "buddhist", "hindu", "atheist", "agnostic"
    ),
    "EMAIL": lambda c: f"contains({c}, '@')",
    "IP_ADDRESS": lambda c: f"right({c}, 3) RLIKE '[0-9]'",
    "MAC_ADDRESS": lambda c: f"length({c}) BETWEEN 17 AND 19",
}


def _found(column: str, class_name: str, pattern: str) -> str:
    test = f"{column} RLIKE {quoted(pattern)}"
    usual = any(name == class_name and p == pattern for name, p, _ in DATA_PATTERNS)
    return f"({NEEDED[class_name](column)}) AND {test}" if usual and class_name in NEEDED else test


def pattern_matches(
    df: DataFrame, table: str, columns: Sequence[str] = (), patterns: Sequence[Pattern] = DATA_PATTERNS
) -> DataFrame:
    """Per column and pattern: values, matching values, and score times match share.

    A value matches when the pattern is found in it. All counts come from one
    scan of the text columns.
    """
    names = list(columns) or text_columns(df)
    aggs = [measure(f"count({named(c)})", f"n{i}") for i, c in enumerate(names)]
    for i, c in enumerate(names):
        aggs += [measure(f"count_if({_found(named(c), name, p)})", f"m{i}_{j}") for j, (name, p, _) in enumerate(patterns)]
    return long_form(df.agg(*aggs), [
        {
            "table_name": quoted(table), "column_name": quoted(c), "rule_no": str(j), "class_name": quoted(name),
            "value_count": f"n{i}", "match_count": f"m{i}_{j}",
            "score": f"CASE WHEN n{i} > 0 THEN {score}D * m{i}_{j} / n{i} ELSE 0.0D END",
        }
        for i, c in enumerate(names)
        for j, (name, _, score) in enumerate(patterns)
    ])


def name_matches(fields: DataFrame, patterns: Sequence[Pattern] = NAME_PATTERNS, column: str = "column_name") -> DataFrame:
    """Every rule whose pattern matches the whole column name.

    The rules are literal expressions in one projection: each pattern compiles
    once per task and the fields are never joined with anything.
    """
    hits = ", ".join(
        f"CASE WHEN {named(column)} RLIKE {quoted(f'^(?:{p})$')} "
        f"THEN named_struct('rule_no', {i}, 'class_name', {quoted(name)}, 'score', {score}D) END"
        for i, (name, p, score) in enumerate(patterns)
    )
    return fields.select(*fields.columns, F.expr(f"inline(filter(array({hits}), h -> h IS NOT NULL))"))


def best_class(
    scored: DataFrame, keys: Sequence[str] = ("table_name", "column_name"), threshold: float = CLASS_THRESHOLD
) -> DataFrame:
    """The class with the highest score per column; a tie goes to the earlier rule."""
    best = F.max(F.struct("score", (-F.col("rule_no")).alias("rank"), "class_name")).alias("best")
    return (
        scored.where(F.col("score") >= threshold).groupBy(*keys).agg(best)
        .select(*keys, "best.class_name", "best.score")
    )


def classify_by_name(fields: DataFrame, threshold: float = CLASS_THRESHOLD) -> DataFrame:
    return best_class(name_matches(fields), threshold=threshold)


def classify_by_data(
    frames: Mapping[str, DataFrame], threshold: float = CLASS_THRESHOLD, patterns: Sequence[Pattern] = DATA_PATTERNS
) -> DataFrame:
    """Best class of each text column by its values; hand in samples to spare time."""
    parts = [pattern_matches(df, name, patterns=patterns) for name, df in frames.items() if text_columns(df)]
    return best_class(reduce(DataFrame.unionByName, parts), threshold=threshold)


def class_flags(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, True) for c in PERSONAL_CLASSES], "class_name string, pii boolean")


def mark_pii(classified: DataFrame) -> DataFrame:
    """Add whether the class is personal data; the lookup side is the class list."""
    flags = F.broadcast(class_flags(classified.sparkSession))
    return classified.join(flags, "class_name", "left").select(
        *classified.columns, F.coalesce("pii", F.lit(False)).alias("pii")
    )


def generator_rows(spark: SparkSession) -> DataFrame:
    rows = [(c, g, json.dumps(p, sort_keys=True), same, once) for c, g, p, same, once in GENERATORS]
    return spark.createDataFrame(
        rows, "class_name string, generator string, params string, consistent boolean, unique_values boolean"
    )


def attach_generators(classified: DataFrame) -> DataFrame:
    """Generator and settings of each class, null where the class has none."""
    rules = F.broadcast(generator_rows(classified.sparkSession))
    return classified.join(rules, "class_name", "left").select(
        *classified.columns, "generator", "params", "consistent", "unique_values"
    )


def classify(fields: DataFrame, frames: Mapping[str, DataFrame], threshold: float = CLASS_THRESHOLD) -> DataFrame:
    """Name and value evidence together, the best class of each column, and its PII flag."""
    by_name = name_matches(fields).select("table_name", "column_name", "rule_no", "class_name", "score")
    by_data = reduce(DataFrame.unionByName, [
        pattern_matches(df, name) for name, df in frames.items() if text_columns(df)
    ]).select("table_name", "column_name", (F.col("rule_no") + len(NAME_PATTERNS)).alias("rule_no"), "class_name", "score")
    return mark_pii(best_class(by_name.unionByName(by_data), threshold=threshold))


# Kinds of text by their shape. A failed cast is far dearer than a failed shape, so only dates and times are cast, and only
# where the shape allows it.
WHOLE = r"^[+-]?[0-9]+$"
PLAIN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
FLOAT = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[fd]?|nan|inf|infinity)$"
BOOL = r"(?i)^(t|true|y|yes|1|f|false|n|no|0)$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
DATETIME = r"^[+-]?\d{4,6}(-|$)"
#: What may follow a text that a shape's end matches.
LINE_ENDS = "\n\r\u0085\u2028\u2029"
#: What is kept of a column: values, values of each kind, and the most digits before and behind the point.
TEXT_STATE = ("values", "whole", "longs", "plain", "floats", "bools", "dates", "times", "whole_digits", "decimals", "float_digits")
_MOST = ("whole_digits", "decimals", "float_digits")


def text_state(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """What the texts of each column look like, in a form that can be merged: counts add up, most digits are the larger.

    Each text is a row of its own and is looked at once: only what is no plain number meets the other shapes, and digits are
    counted by cutting signs, zeros and the line end that ``$`` lets through off the ends. Whole numbers of more digits than
    64 bits hold are not cast, as a cast that fails is many times dearer than all shapes together.
    """
    names = list(columns) or text_columns(df)
    is_a = lambda shape: f"t RLIKE {quoted(shape)}"
    texts = long_form(df, [{"i": str(i), "v": named(c)} for i, c in enumerate(names)]).where("v IS NOT NULL")
    texts = texts.selectExpr("i", "trim(v) AS t").selectExpr("i", "t", f"{is_a(PLAIN)} AS plain", "length(t) AS size")
    texts = texts.selectExpr(
        "i", "t", "size", "plain", "plain AND NOT contains(t, '.') AS whole", f"CASE WHEN plain THEN true ELSE {is_a(FLOAT)} END AS floats"
    ).selectExpr("*", f"CASE WHEN floats THEN trim(LEADING '+-0' FROM trim(TRAILING {quoted(LINE_ENDS)} FROM t)) END AS n")
    mantissa = "trim(TRAILING 'fd' FROM substring_index(lower(n), 'e', 1))"
    behind = "CASE WHEN whole THEN 0 ELSE length(trim(TRAILING '0' FROM substring_index(n, '.', -1))) END"
    found = {
        "values": "count(1)", "whole": "count_if(whole)", "longs": "count(CASE WHEN whole AND length(n) <= 19 THEN try_cast(t AS bigint) END)",
        "plain": "count_if(plain)", "floats": "count_if(floats)", "bools": f"count_if(size <= 7 AND {is_a(BOOL)})",
        "dates": f"count(CASE WHEN size BETWEEN 10 AND 12 AND {is_a(DATE)} THEN try_cast(t AS date) END)",
        "times": f"count(CASE WHEN (size <= 9 OR contains(t, '-')) AND {is_a(DATETIME)} THEN try_cast(t AS timestamp_ntz) END)",
        "whole_digits": "max(CASE WHEN plain THEN length(substring_index(n, '.', 1)) END)",
        "decimals": f"max(CASE WHEN plain THEN {behind} END)",
        "float_digits": f"max(CASE WHEN floats AND left(n, 1) NOT IN ('n', 'N', 'i', 'I') THEN length(replace(trim(TRAILING '0' FROM {mantissa}), '.', '')) END)",
    }
    states = texts.groupBy("i").agg(*[F.expr(f"CAST(coalesce({found[k]}, 0) AS BIGINT)").alias(k) for k in TEXT_STATE])
    # a column without a text has a state too
    none = long_form(df.sparkSession.range(1), [{"i": str(i), **{k: "0L" for k in TEXT_STATE}} for i in range(len(names))])
    whole = states.unionByName(none).groupBy("i").agg(*[(F.max if k in _MOST else F.sum)(k).alias(k) for k in TEXT_STATE])
    return whole.select(F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1).alias("column_name"), *TEXT_STATE)


def merge_text_states(states: DataFrame) -> DataFrame:
    """States of parts of a table as the state of the whole."""
    return states.groupBy("column_name").agg(*[(F.max if k in _MOST else F.sum)(k).alias(k) for k in TEXT_STATE])


def text_types(states: DataFrame) -> DataFrame:
    """The narrowest type that holds every value of a column without losing a digit, as a name and as Spark writes it.

    Whole numbers of 64 bits; decimals with up to 29 digits before and 9 behind the point; decimals of up to 38 digits in all;
    floats, if no number has more digits than a float keeps; flags, days, times; else text.
    """
    all_of = lambda kind: (F.col("values") > 0) & (F.col(kind) == F.col("values"))
    digits = F.col("whole_digits") + F.col("decimals")
    # the float 0.1 is written with 17 digits at most; 15 always come back
    exact = F.col("float_digits") <= 15
    choice = (
        F.when(all_of("longs"), "INT64")
        .when(all_of("plain") & (F.col("whole_digits") <= 29) & (F.col("decimals") <= 9), "NUMERIC")
        .when(all_of("plain") & (digits <= 38), "BIGNUMERIC")
        .when(all_of("floats") & exact & ~all_of("plain"), "FLOAT64")
        .when(all_of("bools"), "BOOL").when(all_of("dates"), "DATE").when(all_of("times"), "DATETIME").otherwise("STRING")
    )
    wide = F.format_string("decimal(38,%d)", F.col("decimals"))
    spark_type = (
        F.when(F.col("inferred_type") == "BIGNUMERIC", wide).when(F.col("inferred_type") == "NUMERIC", "decimal(38,9)")
        .otherwise(F.element_at(F.create_map(*[F.lit(x) for pair in _SPARK_TYPES.items() for x in pair]), F.col("inferred_type")))
    )
    return states.withColumn("inferred_type", choice).withColumn("spark_type", spark_type)


_SPARK_TYPES = {
    "INT64": "bigint", "FLOAT64": "double", "BOOL": "boolean", "DATE": "date", "DATETIME": "timestamp_ntz", "STRING": "string",
}


def infer_text_types(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """The narrowest type that every non-null text of a column can be read as."""
    return text_types(text_state(df, columns)).select("column_name", F.col("values").alias("value_count"), "inferred_type")


def typed_texts(df: DataFrame, states: DataFrame) -> DataFrame:
    """Text columns read as the types their states tell; one row per column is read up front."""
    kinds = {r["column_name"]: r["spark_type"] for r in text_types(states).select("column_name", "spark_type").collect()}
    return df.select(*[F.trim(F.col(named(c))).cast(kinds[c]).alias(c) if kinds.get(c, "string") != "string" else F.col(named(c)) for c in df.columns])
