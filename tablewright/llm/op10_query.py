"""op10: license phrases and templates in ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.license_scans import BREAK, LOWER, TEMPLATES, UPPER, scan_licenses, template_sets
from tablewright.llm.shared import query, table

_TEMPLATES = ", ".join(
    f"('{label}', [{', '.join(repr(w) for w in words)}], {need})" for label, (words, need) in template_sets(TEMPLATES, 0.9).items())

SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '{BREAK}'), lambda x: x <> '') AS w FROM docs),
places AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS i, w FROM w WHERE list_contains(w, 'license')),
base AS (
  SELECT r, i - 1 AS i, CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit'
    WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache'
    WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END AS label FROM places),
lines AS (SELECT r, string_split(t, chr(10)) AS l FROM docs),
block AS (
  SELECT r, list_distinct(list_filter(regexp_split_to_array(array_to_string(l[i:i + 2], chr(10)), '{BREAK}'), lambda x: x <> '')) AS b
  FROM (SELECT r, l, unnest(range(1, len(l) + 1)) AS i FROM lines)),
template AS (SELECT * FROM (VALUES {_TEMPLATES}) AS x(label, words, need)),
met AS (
  SELECT r, label, len(list_intersect(words, b)) / len(words) AS c FROM block, template
  WHERE len(list_intersect(words, b)) >= need),
labelled AS (
  SELECT r, label, c, NULL AS i FROM met UNION ALL SELECT r, label, 1.0, i FROM base WHERE label IS NOT NULL),
per_row AS (
  SELECT r, count(i) AS n, min(i) AS f, max(i) AS l, list_sort(list_distinct(list(label))) AS labels,
    list_sort(list_distinct(list(label) FILTER (i IS NOT NULL))) AS bases, max(c) AS c FROM labelled GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word,
  coalesce(array_to_string(bases, ','), '') AS base_labels, coalesce(array_to_string(labels, ','), '') AS labels,
  coalesce(c, 0)::DOUBLE AS score
FROM w LEFT JOIN per_row USING (r)
"""


@query("op10_license_scans", SQL)
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    both = F.sort_array(F.array_distinct(F.concat("base_labels", "template_labels")))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.col("containment")).alias("score"))
