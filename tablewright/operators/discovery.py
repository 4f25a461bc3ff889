"""The whole discovery run: scope, crawl, sample, measure, classify."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import profiling
from tablewright.operators.joins import attach_descriptions
from tablewright.rules.patterns import CLASS_THRESHOLD
from tablewright.session import scratch_path
from tablewright.sources import catalog
from tablewright.sources.tables import sample


def discover(
    frames: Mapping[str, DataFrame], schema_name: str, include: DataFrame | None = None, exclude: DataFrame | None = None,
    descriptions: DataFrame | None = None, whole: bool = False, threshold: float = CLASS_THRESHOLD,
) -> DataFrame:
    """One row per field: type, counts, null share, class of personal data, description.

    Tables out of scope are not read. Fields are counted over the whole tables.
    Values are classified on a sample of 10 to 100 rows per table, which is
    stored once, or on every row with ``whole``. Text columns that hold JSON in
    all rows read are opened first, with the schema of the whole column; where
    other text lies beyond the sample, it stays beside in ``<column>_text``.
    """
    spark = next(iter(frames.values())).sparkSession
    known = spark.createDataFrame([(schema_name, name) for name in frames], "schema_name string, table_name string")
    # one row per table name
    chosen = {r["table_name"] for r in catalog.in_scope(known, include, exclude).collect()}
    kept, read = {}, {}
    for name, df in frames.items():
        if name not in chosen:
            continue
        rows = df
        if not whole:
            path = scratch_path(spark, "sample")
            sample(df).write.parquet(path)
            rows = spark.read.schema(df.schema).parquet(path)
        for column in catalog.json_columns(rows):
            schema, rest = catalog.json_schema(df, column), None
            if not whole and not df.where(F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull()).isEmpty():
                rest = f"{column}_text"
                while rest in df.columns:
                    rest += "_"
            df, rows = catalog.open_json(df, column, schema, rest), catalog.open_json(rows, column, schema, rest)
        kept[name], read[name] = df, rows
    fields = catalog.crawl(kept, schema_name)
    top = fields.where("top_level").select("table_name", "column_name")
    classes = profiling.classify(top, read, threshold).select(
        "table_name", F.col("column_name").alias("field_path"), "class_name", "score", "pii"
    )
    shares = reduce(DataFrame.unionByName, [profiling.null_percentages(df, name) for name, df in read.items()])
    found = fields.join(classes, ["table_name", "field_path"], "left").join(
        shares.withColumnRenamed("column_name", "field_path"), ["table_name", "field_path"], "left"
    )
    return attach_descriptions(found, descriptions) if descriptions is not None else found
