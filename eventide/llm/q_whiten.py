"""op11: all embeddings whitened onto 16 principal components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import whiten
from eventide.llm.registry import query


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
