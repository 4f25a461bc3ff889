"""op4: line-first cleaning of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.quality_lines import BOILERPLATE, quality_rules
from tablewright.llm.shared import query, table

_FURNITURE = " OR ".join(f"contains(lower({{0}}), '{p}')" for p in BOILERPLATE)

SQL = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM base)),
starts AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i AS step
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(step, 8))) AS n FROM starts GROUP BY doc_id),
signs AS (
  SELECT doc_id, regexp_matches(t, '[!?#*$%&~^=_<>]{{2,}}') AS runs, regexp_matches(t, '[|»«•›‹→]') AS bars,
    ({_FURNITURE.format('t')}) AS furniture FROM base),
line AS (
  SELECT doc_id, j, l, list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    regexp_replace(l, '[\x20\x09-\x0D]', '', 'g') AS c,
    len(regexp_split_to_array(l, '[!?#*$%&~^=_<>]{{2,}}')) - 1 AS runs,
    length(l) - length(regexp_replace(l, '[|»«•›‹→]', '', 'g')) AS bars
  FROM (SELECT doc_id, unnest(lines) AS l, unnest(range(1, len(lines) + 1)) AS j FROM base)),
judged AS (
  SELECT line.doc_id, l, length(c) AS n_chars,
    (len(w) < 5 AND NOT regexp_matches(l, '[.!?:;…。！？]'))
    OR (s.runs AND line.runs >= 3 AND line.runs >= 0.3 * len(w))
    OR (s.bars AND line.bars >= 3 AND 4 * line.bars >= len(w))
    OR (s.furniture AND ({_FURNITURE.format('l')}) AND len(w) <= 40)
    OR (len(w) >= 4 AND 2 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) >= len(w)) AS bad
  FROM line JOIN signs s USING (doc_id) WHERE length(c) > 0),
per_doc AS (
  SELECT doc_id, sum(n_chars) AS all_chars, coalesce(sum(n_chars) FILTER (NOT bad), 0) AS stay_chars,
    count(*) - count(DISTINCT l) AS dup FROM judged GROUP BY doc_id),
counted AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words, coalesce(all_chars, 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(stay_chars, 0) AS stay
  FROM base b LEFT JOIN per_doc p USING (doc_id) LEFT JOIN covered c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND stay >= 0.5 * word_chars) AS kept
FROM counted
"""


@query("op4_quality_lines", SQL)
def op4_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"quality.{f}" for f in fields])
