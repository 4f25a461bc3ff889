"""op2: secrets in ``documents``, weighed by how many owners hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.secret_scans import BASE, LEAD, PATTERNS, PLACEHOLDERS, VALUE, scan_secrets
from tablewright.llm.shared import query, table


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_FOUND = "\nUNION ALL\n".join(
    f"""SELECT r, doc_id, source, lang, '{kind}' AS kind, {rank} AS rank, k, found,
      list_sum(list_transform(gaps[1:k], lambda x: length(x)))
      + coalesce(list_sum(list_transform(all_found[1:k - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(all_found) AS found, unnest(range(1, len(all_found) + 1)) AS k FROM (
      SELECT r, doc_id, source, lang, regexp_extract_all(t, {_quoted(pattern)}) AS all_found,
        regexp_split_to_array(t, {_quoted(pattern)}) AS gaps FROM docs))"""
    for rank, (kind, pattern) in enumerate(PATTERNS.items(), 1))

SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS source, lang, coalesce(text, '') AS t FROM documents),
raw AS ({_FOUND}),
hit AS (
  SELECT r, doc_id, source, concat_ws('/', nullif(source, ''), lang) AS repository, kind, rank, start::BIGINT AS s,
    (start + length(found))::BIGINT AS e, CASE WHEN kind = 'assign' THEN regexp_extract(found, {_quoted(f'^{LEAD}({VALUE})$')}, 1) ELSE found END AS v
  FROM raw),
fit AS (SELECT * FROM hit WHERE CASE kind WHEN 'assign' THEN length(v) >= 6
  WHEN 'live' THEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') ELSE true END),
owned AS (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT (source, repository)) AS repositories FROM fit GROUP BY v),
weighed AS (
  SELECT fit.*, CASE WHEN owners >= 3 THEN 'example'
    WHEN length(v) >= 16 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
      AND len(list_distinct(string_split(v, ''))) >= 8 AND NOT regexp_matches(v, {_quoted(PLACEHOLDERS)}) THEN 'live'
    ELSE 'weak' END AS verdict
  FROM fit JOIN owned USING (v)),
kept AS (
  SELECT * FROM weighed w WHERE kind <> 'live' OR (verdict = 'live' AND NOT EXISTS (
    SELECT 1 FROM weighed b WHERE b.r = w.r AND b.kind <> 'live' AND b.s < w.e AND b.e > w.s))),
per_row AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'live') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
    count(*) FILTER (verdict = 'live') AS live, count(*) FILTER (verdict = 'example') AS example FROM kept GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live, 0) AS n_live, coalesce(example, 0) AS n_example
FROM docs LEFT JOIN per_row USING (r)
"""


def digest(found: DataFrame) -> DataFrame:
    spans = F.col("spans")

    def count(field: str, value: str) -> F.Column:
        return F.size(F.filter(spans, lambda x: x[field] == value)).cast("long")

    def listed(array) -> F.Column:
        return F.array_join(F.transform(array, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select(
        "doc_id", *[count("kind", kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(F.filter(spans, lambda x: x["kind"] != "live")), 256).alias("base_sha256"), listed(spans).alias("spans"),
        count("verdict", "live").alias("n_live"), count("verdict", "example").alias("n_example"),
    )


@query("op2_secret_scans", SQL)
def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_secrets(table(spark, sf_dir, "documents")))
