"""Print, file and Kafka sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(df: DataFrame, label: str) -> DataFrame:
    """``print("high")``: rows with a label prefix column (``show()`` it on
    a batch, ``format("console")`` on a stream)."""
    return df.select(F.lit(label).alias("label"), *df.columns)


def write_rows(df: DataFrame, path: str, fmt: str = "csv", mode: str = "append",
               options: dict | None = None) -> None:
    """Row-format (csv/json/text) or bulk-format (parquet) batch write."""
    w = df.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)


def kafka_frame(df: DataFrame, value: Column, key: Column | None = None,
                partition: Column | None = None, topic: str | None = None) -> DataFrame:
    """Frame in the Kafka sink's layout (``key``, ``value`` strings, optional
    ``partition``/``topic``).  Spark's Kafka sink delivers at least once; a
    deterministic ``key`` lets consumers drop replays (exactly-once by
    dedup)."""
    cols = [value.cast("string").alias("value")]
    if key is not None:
        cols.append(key.cast("string").alias("key"))
    if partition is not None:
        cols.append(partition.cast("int").alias("partition"))
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)


def write_kafka(frame: DataFrame, servers: str, topic: str, stream: bool = False, checkpoint: str | None = None):
    """Write a :func:`kafka_frame` (needs the Kafka connector jar)."""
    if stream:
        w = (frame.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("topic", topic).option("checkpointLocation", checkpoint))
        return w.start()
    frame.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None


def document_frame(df: DataFrame, fields: list[str], id_cols: list[str], index: str) -> DataFrame:
    """Index documents: every field as a string in a JSON map, with a
    deterministic document id (sha-256 of ``id_cols``), so a replayed batch
    overwrites the same documents instead of adding copies."""
    doc = F.to_json(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))]))
    doc_id = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols]), 256)
    return df.select(F.lit(index).alias("index"), doc_id.alias("doc_id"), doc.alias("doc"))
