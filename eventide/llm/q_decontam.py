"""op2: words of every document inside 10-word windows of the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontam as D
from eventide.llm._text import LOWER, UPPER, WORD
from eventide.llm.q_documents import documents
from eventide.llm.registry import query


def _words(table: str, key: str) -> str:
    return f"SELECT row_number() OVER () AS r, {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM {table}"


SQL = f"""
WITH d AS ({_words('documents', 'doc_id')}), b AS ({_words('benchmark', 'item_id')}),
item AS (SELECT DISTINCT item_id, array_to_string(w[k:k + {D.WINDOW - 1}], ' ') AS g, len(w[k:k + {D.WINDOW - 1}]) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {D.WINDOW - 1}, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item),
place AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, k, n, item_id FROM place JOIN item USING (g, n)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN ids USING (r)"""


@query("op2_decontamination", SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = D.build_index(documents(spark, sf_dir))
    found = D.report(index, D.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
