"""Stream sources.

Services (socket, Kafka) are thin option builders over Spark's readers; a
file stream reads one file per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.scalar import to_event_time


def socket_lines(spark: SparkSession, host: str = "localhost", port: int = 7777) -> DataFrame:
    """``socketTextStream(host, port)``: ``value string`` per line (tests
    use a file stream instead; no port is opened here)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_values(spark: SparkSession, servers: str, topic: str | None = None,
                 pattern: str | None = None, starting: str = "latest",
                 starting_timestamp: int | None = None, extra: dict | None = None) -> DataFrame:
    """Kafka topic (or ``pattern``, with partition discovery) as string
    values plus the record timestamp.  ``starting``: earliest | latest | a
    JSON of per-partition offsets; ``starting_timestamp`` (ms) starts from a
    point in time.  Needs the Kafka connector on the classpath."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    r = r.option("subscribePattern", pattern) if pattern else r.option("subscribe", topic)
    if starting_timestamp is not None:
        r = r.option("startingTimestamp", str(starting_timestamp))
    else:
        r = r.option("startingOffsets", starting)
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")


def readings_stream(spark: SparkSession, folder: str, schema: T.StructType,
                    files_per_batch: int = 1) -> DataFrame:
    """Parquet file stream, one file per micro-batch by default, with the
    event time cast to TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
         .parquet(folder))
    return s.withColumn("ts", to_event_time("ts"))
