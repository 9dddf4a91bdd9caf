"""Time characteristics and watermark helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalar import to_event_time


def with_processing_time(df: DataFrame, name: str = "proc_ts") -> DataFrame:
    """Processing time: the wall clock when the batch runs (one value per
    micro-batch, coarser than per row)."""
    return df.withColumn(name, F.current_timestamp())


def with_ingestion_time(df: DataFrame, name: str = "ts") -> DataFrame:
    """Ingestion time: stamp rows at the source, then use that column as
    event time (watermark it like any event time)."""
    return df.withColumn(name, F.current_timestamp())


def bounded_out_of_order(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark = max event time seen - ``delay`` (``"0 seconds"`` for
    ascending timestamps).  Casts TIMESTAMP_NTZ to TIMESTAMP first."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        df = df.withColumn(ts, to_event_time(ts))
    return df.withWatermark(ts, delay)


def punctuated(df: DataFrame, ts: str, marker: Column, delay: str = "0 seconds",
               name: str = "marker_ts") -> DataFrame:
    """Punctuated watermark: only rows where ``marker`` holds advance the
    clock (the marker column is NULL elsewhere, and NULLs do not move a
    watermark).  Windows must then be defined on ``name``, or state
    processors must compare against the watermark themselves."""
    col = F.when(marker, to_event_time(ts))
    return df.withColumn(name, col).withWatermark(name, delay)
