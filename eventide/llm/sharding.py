"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own
(an offset and a step from its name, so the order visits each slot once).
Shards take turns claiming their next free slot until the table is full:
slot counts differ by at most one, and when a shard joins or leaves few slots
change owner.  The table has a fixed size, so it is broadcast, and a row finds
its shard by one hash and one lookup without a shuffle.

Cases: a null key places like the empty string; equal keys always share a
shard; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm._text import fresh

SLOTS = 10_007          # prime, over 100 slots for each of the default shards
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """Owner (index into ``shards``) of every slot.  Work and size are set by
    ``slots`` alone, never by the data."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and not empty")
    if slots < len(shards) or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError(f"slots must be a prime of at least {len(shards)}, not {slots}")
    digest = [hashlib.md5(s.encode()).digest() for s in shards]
    at = [int.from_bytes(d[:8], "big") % slots for d in digest]
    step = [int.from_bytes(d[8:], "big") % (slots - 1) + 1 for d in digest]
    owner, left = [-1] * slots, slots
    while left:
        for k in range(len(shards)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % slots
            owner[at[k]] = k
            left -= 1
            if not left:
                break
    return owner


def slot_of(key, slots: int = SLOTS):
    """Slot of a key: the first 60 bits of its MD5, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``(slot, shard)``, one row for each slot."""
    names = ",".join(map(str, lookup_table(shards, slots)))
    owners = spark.range(1).select(F.posexplode(F.split(F.lit(names), ",")).alias("slot", "k"))
    return owners.select("slot", F.element_at(F.array(*map(F.lit, shards)), F.col("k").cast("int") + 1).alias("shard"))


def assign(docs: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS,
           slots: int = SLOTS, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``docs`` with its slot and shard; columns of these names are replaced."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (shard, slot)]
    at, owner = fresh(docs.columns, "__slot", "__shard")
    placed = docs.select(*kept, slot_of(F.col(f"`{key}`"), slots).alias(at))
    table = table_frame(docs.sparkSession, shards, slots).select(F.col("slot").alias(at), F.col("shard").alias(owner))
    return placed.join(F.broadcast(table), at).select(*kept, F.col(at).alias(slot), F.col(owner).alias(shard))


def write_shards(placed: DataFrame, path: str, shard: str = "shard", files_a_shard: int = 8) -> None:
    """One folder for each shard.  Rows of a shard go to ``files_a_shard``
    tasks by a hash of the row's own columns, so no shard is one task's work."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns if c != shard]), F.lit(files_a_shard))
    salted, = fresh(placed.columns, "__salt")
    placed.withColumn(salted, salt).repartition(shard, salted).drop(salted).write.partitionBy(shard).parquet(path)


def oracle(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> str:
    owners = ",".join(map(str, lookup_table(shards, slots)))
    names = ",".join(shards)
    return f"""
SELECT doc_id, slot,
  string_split('{names}', ',')[string_split('{owners}', ',')[slot + 1]::INT + 1] AS shard
FROM (SELECT doc_id, (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {slots})::INT AS slot
      FROM documents)"""
