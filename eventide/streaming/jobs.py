"""Ready-made streaming jobs: the streaming forms of the flagship and of
the keyed alerts, built from the same operators as the batch queries.

Each returns a streaming DataFrame; start it with
:func:`eventide.streaming.runner.start` (checkpointed, restartable).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalar import f_to_c, java_split, parse_duration_us
from eventide.operators.windows import window_agg
from eventide.streaming import processors as P


def window_average(readings: DataFrame, size: str = "15 seconds", delay: str = "3 seconds",
                   allowed_lateness: str | None = None) -> DataFrame:
    """Per-sensor average Celsius temperature per tumbling window, emitted
    when the watermark passes the window end (append mode).  With
    ``allowed_lateness`` the watermark delay grows by that much, so late
    rows inside it still update their window (use update mode to see the
    re-firings)."""
    d = parse_duration_us(delay) + (parse_duration_us(allowed_lateness) if allowed_lateness else 0)
    s = readings.withWatermark("ts", f"{d // 1000} milliseconds")
    out = window_agg(s, "id", "ts", size, [F.avg(f_to_c("temperature")).alias("avg_temp_c")])
    return out.select("id", "window_end", F.round("avg_temp_c", 6).alias("avg_temp_c"))


def late_firings(readings: DataFrame, size: str, delay: str, allowed: str) -> DataFrame:
    """Window counts per sensor with first firings, updates by late rows
    inside the allowance, and the rows beyond it (kind ``late``)."""
    p = P.LateFirings(parse_duration_us(size) // 1000, parse_duration_us(allowed) // 1000)
    out = P.apply(readings.withWatermark("ts", f"{parse_duration_us(delay) // 1000 + p.slack} milliseconds"), p)
    return out.withColumn("window_end", F.timestamp_millis("window_end_ms")).drop("window_end_ms")


def word_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """Streaming word count (run in update or complete mode)."""
    words = lines.select(F.explode(java_split(F.col(col), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def jump_alerts(readings: DataFrame, threshold: float = 10.0, ttl: str | None = None,
                delay: str = "0 seconds") -> DataFrame:
    """Per-sensor jump alerts; with ``ttl`` the state of a silent sensor is
    dropped by an event-time timer."""
    if ttl is None:
        return P.apply(readings, P.JumpAlert(threshold), time_mode="None")
    s = readings.withWatermark("ts", delay)
    return P.apply(s, P.JumpAlert(threshold, parse_duration_us(ttl) // 1000))


def rising_alerts(readings: DataFrame, interval: str = "10 seconds", delay: str = "0 seconds") -> DataFrame:
    s = readings.withWatermark("ts", delay)
    out = P.apply(s, P.RisingAlert(parse_duration_us(interval) // 1000))
    return out.select("id", F.timestamp_millis("alert_ms").alias("alert_ts"))


def min_max_per_window(readings: DataFrame, size: str, delay: str) -> DataFrame:
    """Window minimum and maximum stamped with the window end."""
    s = readings.withWatermark("ts", delay)
    return window_agg(s, "id", "ts", size, [F.min("temperature").alias("min_temp"),
                                            F.max("temperature").alias("max_temp")])
