"""Keys and physical partitioning.

Key selectors resolve to Column expressions for ``groupBy`` / window
partitions; the partition helpers map the redistribution strategies onto
Spark exchanges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side of a join is broadcast up to this measured size.
BROADCAST_BYTES = 32 << 20


def key_columns(df: DataFrame, *spec) -> list[Column]:
    """Key by position (int), field name, nested path (``"address.zip"``),
    wildcard over a struct (``"birthday.*"``) or an expression (selector)."""
    out: list[Column] = []
    for s in spec:
        if isinstance(s, int):
            out.append(F.col(df.columns[s]))
        elif isinstance(s, str) and s.endswith(".*"):
            struct = s[:-2]
            fields = df.select(f"{struct}.*").columns
            out.extend(F.col(f"{struct}.{f}").alias(f"{struct}_{f}") for f in fields)
        elif isinstance(s, str):
            out.append(F.col(s).alias(s.replace(".", "_")) if "." in s else F.col(s))
        else:
            out.append(s)
    return out


def key_by(df: DataFrame, *spec, name: str = "key") -> DataFrame:
    """Attach the key as one column (a struct when composite)."""
    cols = key_columns(df, *spec)
    key = cols[0] if len(cols) == 1 else F.struct(*cols)
    return df.withColumn(name, key)


def shuffle_random(df: DataFrame, n: int) -> DataFrame:
    """Even redistribution whatever the rows hold, equal rows included.
    Spark orders each partition before it deals round-robin, so a retried
    task sends every row to the same place again."""
    return df.repartition(n)


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round-robin redistribution."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Local merge of partitions without a full shuffle (shrink only)."""
    return df.coalesce(n)


def to_single_task(df: DataFrame) -> DataFrame:
    """Everything to one task (``global``).  Only for small, already
    reduced data; never on raw input at scale."""
    return df.coalesce(1)


def by_key(df: DataFrame, n: int, *keys) -> DataFrame:
    """Hash redistribution by key (co-locates a later join/aggregate)."""
    return df.repartition(n, *keys)


def custom_partition(df: DataFrame, n: int, partition_of: Column) -> DataFrame:
    """User partitioner: ``partition_of`` evaluates to a partition number
    in ``[0, n)`` per row (e.g. negative keys to 0, others spread)."""
    return df.repartitionById(n, F.pmod(partition_of, F.lit(n)).cast("int"))


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's rows as JSON text, by one job: an upper bound, within
    a small factor, of what it takes in memory."""
    said = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long")
    return df.agg(F.sum(said)).first()[0] or 0


def broadcast_small(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked to be sent whole to every task (``broadcast``), if its
    measured size allows; else as it is, for a join by shuffle."""
    return F.broadcast(df) if measured_bytes(df) <= most_bytes else df


def with_parallelism(df: DataFrame, n: int) -> DataFrame:
    """Per-step parallelism; the session default is
    ``spark.sql.shuffle.partitions``."""
    return df.repartition(n)
