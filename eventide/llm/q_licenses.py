"""op3: licence phrases and notices in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import licenses as S
from eventide.llm._text import LOWER, UPPER, WORD
from eventide.llm.q_documents import documents
from eventide.llm.registry import query

_GRAMS = ", ".join(f"({n}, {p}, '{' '.join(t.words[p:p + S.K])}')"
                   for n, t in enumerate(S.TEMPLATES) for p in range(len(t.words) - S.K + 1))
_ABOUT = ", ".join(f"({n}, '{t.label}', {t.base}, {len(t.words)}, {(1 << (len(t.words) - S.K + 1)) - 1})"
                   for n, t in enumerate(S.TEMPLATES))
_COVERED = " | ".join(f"(places << {i})" for i in range(S.K))

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
gram(template, place, g) AS (VALUES {_GRAMS}),
about(template, label, base, length, whole) AS (VALUES {_ABOUT}),
spot AS (SELECT r, k - 1 AS i, array_to_string(w[k:k + {S.K - 1}], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {S.K - 2})) AS k FROM d WHERE len(w) >= {S.K})),
vote AS (SELECT r, template, i - place AS diagonal, bit_or(1::BIGINT << place) AS places
  FROM spot JOIN gram USING (g) GROUP BY ALL),
stepped AS (SELECT *, CASE WHEN (diagonal - lag(diagonal) OVER line) * {S.MERGE_WITHIN} <= length THEN 0 ELSE 1 END AS cut,
  base AND places = whole AS exact FROM vote JOIN about USING (template)
  WINDOW line AS (PARTITION BY r, template ORDER BY diagonal)),
run AS (SELECT *, sum(cut) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM stepped),
span AS (SELECT r, template, run, label, base, length, bit_or(places) AS places, sum(exact::INT) AS n_base,
  min(diagonal) FILTER (exact) AS first_base, max(diagonal) FILTER (exact) AS last_base FROM run GROUP BY ALL),
good AS (SELECT *, bit_count({_COVERED}) / length AS cover FROM span
  WHERE n_base > 0 OR NOT base AND bit_count({_COVERED}) / length >= {S.LEAST_COVER}),
doc AS (SELECT r, sum(n_base)::BIGINT AS n_base, min(first_base)::BIGINT AS first_word, max(last_base)::BIGINT AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (n_base > 0) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM good GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN doc USING (r)"""


@query("op3_license_scan", SQL)
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.report(*S.scan(documents(spark, sf_dir)))
