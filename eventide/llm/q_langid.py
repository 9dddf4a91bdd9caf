"""op1: language of every document, learned from two thirds of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import langid as L
from eventide.llm.q_documents import documents
from eventide.llm.registry import query

def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame) -> L.ByteNet | None:
    return L.train(*L.training_rows(docs.where(~held_out()).select("doc_id", "text", "lang")))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = L.identify(docs.select("doc_id", "text"), learned(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
