"""In-memory collections (small fixtures, control rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def from_collection(spark: SparkSession, rows, schema) -> DataFrame:
    """``fromCollection`` / ``fromElements``: a bounded DataFrame."""
    return spark.createDataFrame(list(rows), schema)
