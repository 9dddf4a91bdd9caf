"""op10: toxicity of every document, learned from three quarters of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import toxicity as T
from eventide.llm.q_documents import documents
from eventide.llm.registry import query

PREDICT_FROM = 0.3


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    machine = T.train(*T.training_rows(docs, labels))
    return T.score(docs.select("doc_id", "text"), machine).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
