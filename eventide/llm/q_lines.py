"""op6: every document without lines that many sources share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import linededup as L
from eventide.llm.q_documents import documents
from eventide.llm.registry import query

_BARE = "trim(l, chr(32) || chr(9) || chr(13))"

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, string_split(text, chr(10)) AS ls, text FROM documents),
line AS (SELECT r, source, unnest(ls) AS l FROM d),
common AS (SELECT {_BARE} AS bare FROM line WHERE {_BARE} <> '' GROUP BY ALL HAVING count(DISTINCT source) >= {L.MIN_SITES}),
kept AS (SELECT r, k, l FROM (SELECT r, unnest(range(1, len(ls) + 1)) AS k, unnest(ls) AS l FROM d)
  WHERE {_BARE} NOT IN (SELECT bare FROM common)),
clean AS (SELECT r, string_agg(l, chr(10) ORDER BY k) AS text, count(*) AS n FROM kept GROUP BY r)
SELECT doc_id, coalesce(len(ls), 0)::INT AS n_lines, (coalesce(len(ls), 0) - coalesce(n, 0))::INT AS n_dropped,
  sha256(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(clean.text, '') END) AS text_sha256
FROM d LEFT JOIN clean USING (r)"""


@query("op6_line_dedup", SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.clean(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))
