"""Shared functions under SQL names; each is one expression, so it stays in Catalyst."""

from __future__ import annotations

from pyspark.sql import SparkSession

_PICK = "cast(conv(substr(md5(concat_ws('|', '42', label, value, '0')), 1, 8), 16, 10) as bigint)"

SQL_FUNCTIONS = {
    "tw_null_token(value STRING) RETURNS STRING": "CASE WHEN lower(value) = 'null' THEN NULL ELSE value END",
    "tw_to_int64(value STRING) RETURNS BIGINT": "cast(CASE WHEN lower(value) = 'null' THEN NULL ELSE value END AS BIGINT)",
    "tw_to_float64(value STRING) RETURNS DOUBLE": "cast(CASE WHEN lower(value) = 'null' THEN NULL ELSE value END AS DOUBLE)",
    "tw_entity_id(value STRING) RETURNS BIGINT": "cast(value AS BIGINT)",
    "tw_pick(label STRING, value STRING, items ARRAY<STRING>) RETURNS STRING":
        f"element_at(items, cast({_PICK} % size(items) AS INT) + 1)",
    "tw_interval(months BIGINT, days BIGINT, secs BIGINT) RETURNS STRING":
        "format_string('%s%d-%d %s%d %s%d:%d:%.3f', if(months >= 0, '+', '-'), abs(months) div 12, abs(months) % 12, "
        "if(days >= 0, '+', '-'), abs(days), if(secs >= 0, '+', '-'), abs(secs) div 3600, abs(secs) % 3600 div 60, "
        "cast(abs(secs) % 60 AS DOUBLE))",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session and give back their names."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in SQL_FUNCTIONS]
