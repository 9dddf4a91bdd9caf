"""Seeded sensor generators (scale-out test inputs).

``sensor_walk`` is a bounded table: per sensor a start temperature
``65 + 20 * N(0,1)`` and steps ``0.5 * N(0,1)``, the running sum computed
by a chunked scan.  ``sensor_stream`` is the unbounded form on the
``rate`` source (per-row noise instead of a walk, which would need state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.scan import Scan, scan


def _gauss(seed_col, salt: int):
    """N(0,1) from two hash-uniforms (Box-Muller), deterministic per row."""
    u1 = (F.pmod(F.xxhash64(seed_col, F.lit(salt)), F.lit(1_000_000)) + 1) / F.lit(1_000_001.0)
    u2 = (F.pmod(F.xxhash64(seed_col, F.lit(salt + 1)), F.lit(1_000_000)) + 1) / F.lit(1_000_001.0)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * 3.141592653589793 * u2)


def sensor_walk(spark: SparkSession, n_sensors: int = 10, n_steps: int = 1000,
                start: str = "2024-01-01 00:00:00", step_ms: int = 100, seed: int = 42,
                subtasks: int = 1) -> DataFrame:
    """Readings ``(id, ts, temperature, seq)``; with ``subtasks`` > 1 the
    ids are ``subtask * 10 + i`` as a parallel source would produce."""
    n = n_sensors * subtasks
    rows = spark.range(0, n * n_steps).select(
        (F.col("id") % n).alias("sensor"), (F.col("id") / n).cast("long").alias("step"), F.col("id").alias("seq"))
    sub = (F.col("sensor") / n_sensors).cast("long")
    idx = F.col("sensor") % n_sensors
    sid = F.concat(F.lit("sensor_"), (sub * 10 + idx).cast("string"))
    ts = (F.lit(start).cast("timestamp_ntz")
          + F.make_dt_interval(secs=(F.col("step") * step_ms / 1000.0).cast("decimal(18,6)")))
    inc = F.when(F.col("step") == 0, 65 + 20 * _gauss(F.col("sensor") + seed, 1)).otherwise(
        0.5 * _gauss(F.col("seq") + seed, 3))
    df = rows.select(sid.alias("id"), ts.alias("ts"), inc.alias("__inc"), "seq")
    out = scan(df, ["id"], "ts", ["seq"], [Scan("temperature", "sum", "__inc")])
    return out.select("id", "ts", F.round("temperature", 6).alias("temperature"), "seq")


def sensor_stream(spark: SparkSession, rows_per_second: int = 100, n_sensors: int = 10,
                  seed: int = 42) -> DataFrame:
    """Unbounded readings from the ``rate`` source, event time = the
    generation time."""
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return r.select(F.concat(F.lit("sensor_"), (F.col("value") % n_sensors).cast("string")).alias("id"),
                    F.col("timestamp").alias("ts"),
                    (65 + 20 * _gauss(F.col("value") % n_sensors + seed, 1)
                     + 0.5 * _gauss(F.col("value") + seed, 3)).alias("temperature"),
                    F.col("value").alias("seq"))


def smoke_levels(df: DataFrame, seed: int = 42) -> DataFrame:
    """Two-valued control input: ``High`` when N(0,1) > 0.8, else ``Low``."""
    return df.withColumn("level", F.when(_gauss(F.col("seq") + seed, 5) > 0.8, "High").otherwise("Low"))
