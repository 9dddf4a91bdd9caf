"""Parquet tables and the reading convention used by every keyed operator.

A *reading* is ``(id, ts, temperature)`` plus a tiebreak ``seq`` that fixes
arrival order among equal timestamps.  The driver's ``events`` table maps as
``id = user_id``, ``ts = ts``, ``temperature = value``, ``seq = event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

READING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``events`` to the reading convention (column-pruned scan)."""
    cols = [F.col("user_id").alias("id"), F.col("ts"),
            F.col("value").alias("temperature"), F.col("event_id").alias("seq")]
    cols += [F.col(k) for k in keep]
    return events.select(*cols)
