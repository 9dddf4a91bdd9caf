"""op13: four-byte codes of all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import vector_codes as C
from eventide.llm.registry import query


def _round(k: int) -> str:
    """Nearest entries under book k - 1, then book k."""
    return f"""
near{k} AS MATERIALIZED (SELECT r, part, min(d * {C.ENTRIES} + e) AS m FROM (
  SELECT r, part, e, sum((x - c) * (x - c)) AS d FROM piece JOIN book{k - 1} USING (part, i) GROUP BY ALL) GROUP BY ALL),
mean{k} AS (SELECT part, m % {C.ENTRIES} AS e, i, sum(x) AS s, count(*) AS n FROM piece JOIN near{k} USING (r, part) GROUP BY ALL),
book{k} AS MATERIALIZED (SELECT part, e, i, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{k - 1} LEFT JOIN mean{k} USING (part, e, i))"""


SQL = f"""
WITH fit AS (SELECT row_number() OVER () AS r, vec_id, label, [floor({C.FACTOR} * x::DOUBLE)::BIGINT for x in embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
kept AS MATERIALIZED (SELECT *, len(q) AS dim FROM fit
  WHERE len(q) = (SELECT len(q) FROM fit GROUP BY len(q) ORDER BY count(*) DESC, len(q) DESC LIMIT 1)),
piece AS MATERIALIZED (SELECT r, (({C.PARTS} * k - 1) // dim)::INT AS part, k AS i, q[k] AS x
  FROM (SELECT r, q, dim, unnest(range(1, dim + 1)) AS k FROM kept)),
start AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS e FROM kept),
book0 AS MATERIALIZED (SELECT part, e, i, x AS c FROM piece JOIN start USING (r) WHERE e < {C.ENTRIES}),
{",".join(_round(k) for k in range(1, C.ROUNDS + 1))},
{_round(C.ROUNDS + 1).split("," + chr(10) + "mean")[0].strip()},
code AS (SELECT r, string_agg(lower(printf('%02x', (m % {C.ENTRIES})::INT)), '' ORDER BY part) AS code, sum(m // {C.ENTRIES})::BIGINT AS error
  FROM near{C.ROUNDS + 1} GROUP BY r),
digest AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY part, e, i)) AS d FROM book{C.ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, d AS codebooks_sha256
FROM kept JOIN code USING (r), digest"""


@query("op13_vector_codes", SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    codes, book = C.encode(rows)
    return C.with_label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(book.sha256()).alias("codebooks_sha256"))
