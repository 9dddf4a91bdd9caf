"""op12: all pages written to WARC archives and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import warc
from eventide.llm.registry import query
from eventide.session import scratch_path

# base32 of 40 hex digits: character i is bits 5 i to 5 i + 4
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) || '0' AS h FROM pages),
b AS (SELECT page_id, octet_length(encode(body)) AS bytes, array_to_string([
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((strpos('0123456789abcdef', substr(h, 5 * i // 4 + 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(h, 5 * i // 4 + 2, 1)) - 1)
      // (1 << (3 - 5 * i % 4))) % 32 + 1, 1) for i in range(32)], '') AS digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS head FROM b)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM head THEN head END AS refers_to FROM g"""


@query("op12_warc", SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.read_archives(spark, path).where("reason IS NULL").select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))
