"""op7: the 10 nearest vectors of every hundredth one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import ann as A
from eventide.llm.registry import query


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return A.search(rows, rows.where("vec_id % 100 = 0"), k=10)
