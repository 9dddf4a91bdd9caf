"""Corpus pipeline: documents to shards in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows its
predecessor kept, and works on what it is given: the classifier of the first
stage is learned from its ``docs``, contamination and mixing rates are those
of the documents that are left.  All but the last return the columns of
``documents``.  Between stages the rows are written as Parquet to the shared
checkpoint folder, so a lost executor repeats part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontam, langid, mixing, sharding, simhash
from eventide.llm._text import fresh
from eventide.llm.components import stored
from eventide.llm.q_langid import learned
from eventide.llm.q_mixing import TARGETS, domains

LEAST_SCORE = 0.3       # of a language's posterior; four equal languages have 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a determined language: no letter at all, or
    no language more likely than ``LEAST_SCORE``."""
    lang, score = fresh(docs.columns, "lang_pred", "score")
    found = langid.identify(docs, learned(docs), lang=lang, score=score)
    return found.where((F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the smallest id."""
    return simhash.dedup(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a 10-word window of a benchmark item go."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as its fitted rate says."""
    return mixing.mix(docs, domains(spark.read.parquet(f"{sf_dir}/labels.parquet")), TARGETS)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's slot and shard."""
    return sharding.assign(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("mixing sources to target weights", mix_to_targets),
    ("sharding", assign_shards),
]

#: Learned posteriors, components and fitted rates are beyond one SQL query.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k + 1}")
    return docs
