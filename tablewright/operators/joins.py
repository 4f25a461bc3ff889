"""Key lookups done as joins: subsets, mappings, missing keys, children and relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.casting import entity_id
from tablewright.operators.keys import last_wins
from tablewright.session import scratch_path


def child_rows(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, key_class: str | None = None
) -> DataFrame:
    """Children whose key is among the parents; the parent key is first cast to its class.

    Parent keys are merged before the shuffle, so a parent that repeats in a
    third of the rows still sends one row per task.
    """
    key = F.col(parent_key)
    keys = parents.select((entity_id(key, key_class) if key_class else key).alias(child_key)).distinct()
    return children.join(keys, child_key, "left_semi")


def entity_subset(roots: DataFrame, root_name: str, links: Sequence[tuple[str, DataFrame, str, str, str]]) -> dict[str, DataFrame]:
    """Rows of the chosen roots and of everything below them.

    Each link is (child name, child table, child key, parent name, parent key),
    parents before children. The keys found at a level are written once to the
    shared folder, so a deep chain does not repeat the joins above it, and a
    lost executor does not restart them.
    """
    found = {root_name: roots}
    stored: dict[tuple[str, str], DataFrame] = {}
    for name, table, child_key, parent, parent_key in links:
        if (parent, parent_key) not in stored:
            keys = found[parent].select(parent_key).where(F.col(parent_key).isNotNull()).distinct()
            path = scratch_path(table.sparkSession, f"keys-{parent}")
            keys.write.parquet(path)
            stored[parent, parent_key] = table.sparkSession.read.schema(keys.schema).parquet(path)
        found[name] = table.join(stored[parent, parent_key].withColumnRenamed(parent_key, child_key), child_key, "left_semi")
    return found


def missing_keys(requested: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Requested keys that the source does not have."""
    return requested.join(source.select(key).distinct(), key, "left_anti")


def require_keys(requested: DataFrame, source: DataFrame, key: str, deleting_child: bool = False) -> None:
    """Fail when a requested key is missing, unless a child is being deleted first."""
    if deleting_child:
        return
    gone = missing_keys(requested, source, key).select(key).take(5)
    if gone:
        raise LookupError(f"not found in the source: {', '.join(str(r[0]) for r in gone)}")


def in_list(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is listed; an empty list keeps none."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(column)).distinct(), column, "left_semi")
    return df.where(F.col(column).isin(list(values))) if values else df.where(F.lit(False))


def not_in_list(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is known and not listed; nulls in the list count for nothing, an empty list keeps all."""
    if isinstance(values, DataFrame):
        listed = values.select(F.col(values.columns[0]).alias(column)).where(F.col(column).isNotNull()).distinct()
        return df if listed.isEmpty() else df.where(F.col(column).isNotNull()).join(listed, column, "left_anti")
    known = [v for v in values if v is not None]
    return df.where(~F.col(column).isin(known)) if known else df


def scope(df: DataFrame, column: str, include: DataFrame, exclude: DataFrame) -> DataFrame:
    """Include list minus exclude list; with no include list, all but the excluded.

    Both lists are single-column frames of names.
    """
    wanted = include.subtract(exclude)
    if wanted.isEmpty():
        return not_in_list(df, column, exclude)
    return in_list(df, column, wanted)


def attach_descriptions(fields: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Description of each (table, path); the last entry for a path counts. Where there is none, what the field says itself stays."""
    final = last_wins(descriptions.where(F.col("description").isNotNull()), ["table_name", "field_path"], ["position"]).drop("position")
    if "description" not in fields.columns:
        return fields.join(final, ["table_name", "field_path"], "left")
    found = fields.join(final.withColumnRenamed("description", "__given"), ["table_name", "field_path"], "left")
    return found.withColumn("description", F.coalesce("__given", "description")).drop("__given")


def param_types(params: DataFrame, columns: DataFrame) -> DataFrame:
    """The declared type of each filter parameter, by column name; the last match wins."""
    final = last_wins(columns.select("column_name", "position", "data_type"), ["column_name"], ["position"])
    return params.join(final.drop("position"), params["field_name"] == final["column_name"], "left").select(
        *params.columns, "data_type"
    )


def replace_keys(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Swap old keys for mapped ones (columns ``source_value``, ``target_value``); unmapped keys stay."""
    pairs = mapping.select(F.col("source_value").alias("__old"), F.col("target_value").alias("__new"))
    return df.join(pairs, df[column] == pairs["__old"], "left").select(
        *[F.coalesce("__new", F.col(column)).alias(c) if c == column else F.col(c) for c in df.columns]
    )


def children_of(
    parents: DataFrame, parent_fields: Mapping[str, str], count, number: str = "child_no", block: int = 10_000
) -> DataFrame:
    """``count`` rows (a number or a column) per parent, carrying the named parent fields.

    Parents with more than ``block`` children are first cut into blocks that
    are spread over the tasks, so one huge parent neither builds a huge array
    nor keeps one task busy.
    """
    fields = [F.col(source).alias(target) for source, target in parent_fields.items()]
    amount = (F.lit(count) if isinstance(count, int) else count).cast("bigint")
    rows = parents.select(*fields, amount.alias("__n")).where(F.col("__n") > 0)
    most = count if isinstance(count, int) else rows.agg(F.max("__n").alias("m")).first()["m"] or 0
    if most <= block:
        return rows.select(*parent_fields.values(), F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias(number))
    blocks = rows.withColumn("__b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / block).cast("bigint"))))
    spread = blocks.repartition(*parent_fields.values(), "__b")
    first = F.col("__b") * block + 1
    numbers = F.sequence(first, F.least(F.col("__n"), (F.col("__b") + 1) * block))
    return spread.select(*parent_fields.values(), F.explode(numbers.cast("array<int>")).alias(number))


# Scores of the relation rules, and what they leave out.
RELATION_SCORES = {
    "field_name_is_id_and_pk": 0.8,
    "field_name_is_id_and_not_pk": 0.6,
    "single_field_pk_and_not_pk": 0.8,
    "common_fields_in_both_pk": 0.8,
    "same_field_names_pk": 0.4,
    "same_field_names_not_pk": 0.2,
}
RELATION_NAMES_LEFT_OUT = ("name", "username")
RELATION_TYPES_LEFT_OUT = ("float", "char")
RELATION_THRESHOLD = 0.4


def relation_candidates(
    fields: DataFrame, threshold: float = RELATION_THRESHOLD, prefix: str = r"^[a-z]{1,2}_"
) -> DataFrame:
    """Table pairs that look related by a shared field, each with its best score.

    ``fields`` has table_name, field_name, source_type and is_pk. Names are
    compared in lower case without the table prefix and separators. Only field
    pairs whose rule can reach the threshold are joined: fields that are no key
    on either side never meet at the usual threshold.
    """
    bare = F.regexp_replace(F.regexp_replace(F.lower("field_name"), prefix, ""), "[_-]", "")
    kind = F.when(F.upper("source_type").startswith("FLOAT"), "float").otherwise(F.lower("source_type"))
    keys = fields.groupBy("table_name").agg(F.sum(F.col("is_pk").cast("int")).alias("n_keys"))
    named = (
        fields.withColumn("norm", bare)
        .where(~F.col("norm").isin(*RELATION_NAMES_LEFT_OUT) & ~kind.isin(*RELATION_TYPES_LEFT_OUT))
        .join(keys, "table_name")
    )
    score = RELATION_SCORES
    left = named.select(
        F.col("table_name").alias("from_table"), F.col("field_name").alias("from_field"), F.col("is_pk").alias("from_pk"),
        F.col("n_keys").alias("from_keys"), (F.col("norm") == "id").alias("is_id"),
        F.when(F.col("norm") == "id", F.concat(F.regexp_replace(F.lower("table_name"), "[_-]", ""), F.lit("id")))
        .otherwise(F.col("norm")).alias("norm"),
    )
    if threshold > score["same_field_names_not_pk"]:
        left = left.where(F.col("from_pk") | F.col("is_id"))
    right = named.select(
        F.col("table_name").alias("to_table"), F.col("field_name").alias("to_field"), F.col("is_pk").alias("to_pk"),
        F.col("n_keys").alias("to_keys"), "norm",
    )
    rule = (
        F.when(F.col("is_id") & F.col("from_pk"), "field_name_is_id_and_pk")
        .when(F.col("is_id"), "field_name_is_id_and_not_pk")
        .when(F.col("from_pk") & ~F.col("to_pk") & (F.col("from_keys") == 1), "single_field_pk_and_not_pk")
        .when(F.col("from_pk") & F.col("to_pk") & (F.col("from_keys") < F.col("to_keys")), "common_fields_in_both_pk")
        .when(F.col("from_pk") & F.col("to_pk") & (F.col("from_keys") == F.col("to_keys")), "same_field_names_pk")
        .when(~F.col("from_pk") & ~F.col("to_pk"), "same_field_names_not_pk")
    )
    points = F.element_at(F.create_map(*[x for n, s in score.items() for x in (F.lit(n), F.lit(s))]), F.col("rule"))
    return (
        left.join(right, "norm")
        .where(F.col("from_table") != F.col("to_table"))
        .withColumn("rule", rule)
        .where(F.col("rule").isNotNull())
        .withColumn("score", points)
        .where(F.col("score") >= threshold)
        .groupBy("from_table", "to_table")
        .agg(F.max(F.struct("score", "from_field", "to_field", "rule")).alias("best"))
        .select("from_table", "to_table", "best.score", "best.from_field", "best.to_field", "best.rule")
    )
