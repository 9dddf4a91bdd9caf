"""op5: rates that mix documents to target weights of quality and toxicity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import mixing as M
from eventide.llm.q_documents import documents
from eventide.llm.registry import query

#: Shares of all tokens that each domain of ``labels`` is to have.
TARGETS = {"good": 0.85, "low": 0.10, "toxic": 0.05}


def domains(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)``: toxic, else good or low by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain"))


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sorted(TARGETS)
    members = M.memberships(documents(spark, sf_dir).select("doc_id", "text"),
                            domains(spark.read.parquet(f"{sf_dir}/labels.parquet")), names)
    found = M.fit_rates(members, [TARGETS[d] for d in names])
    return found.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id", F.col("tokens").cast("long").alias("tokens"), *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(names)],
        "rate", M.copies_of(F.col("rate"), F.col("doc_id")).alias("n_copies"))
