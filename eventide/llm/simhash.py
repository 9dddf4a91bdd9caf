"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``radius`` bits apart have a common variant within
half the radius of both, so every distinct fingerprint emits its ball of half
the radius, variants meet in one shuffle, and the pairs that collide are
deduplicated and verified.  Copies share a fingerprint and are one row before
anything is emitted, so a bucket holds at most one ball of fingerprints
(65 for radius 2) however many documents there are.

Cases: a null or empty text, or one without a word, has fingerprint zero and
links like any other; a text of fewer words than a shingle is one shingle;
rows that repeat, share a doc_id or have none each return a row (a component
whose doc_ids are all null has a null id); an empty table gives no rows;
further columns are ignored by the query and kept by ``dedup``.
"""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm._text import ASCII_LOWER, fresh
from eventide.llm.components import connected_components, stored

SEED = 42       # of XXH64
SHINGLE = 3     # words
RADIUS = 2      # bits


def text_fingerprint(text: bytes, shingle: int) -> int:
    """Fingerprint of one UTF-8 text: bit k is 1 if over half of the shingle
    hashes, repeats included, have it."""
    from xxhash import xxh64_intdigest

    words = text.translate(ASCII_LOWER).split()   # bytes split at \x20 \x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle)))) \
        if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=n)
    rows = -(-n // 255) * 255                     # blocks whose bit sums fit a byte
    bits = np.zeros((rows, 64), np.uint8)
    bits[:n] = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    ones = bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp`` (signed 64-bit) of every row."""
    kept = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    schema = kept.drop("__text").schema.add("fp", "long")

    def run(batches):
        for batch in batches:
            texts = batch.column("__text")
            fps = np.fromiter((text_fingerprint(t.as_py() or b"", shingle) for t in texts),
                              dtype=np.int64, count=len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(fps)],
                                             names=[*keep, "fp"])

    return kept.mapInArrow(run, schema)


def ball(bits: int) -> list[int]:
    """Signed 64-bit masks of at most ``bits`` set bits."""
    masks = [sum(1 << k for k in c) for n in range(bits + 1) for c in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct ``fp`` -> verified pairs ``(a, b)`` at most ``radius`` bits
    apart that connect whatever is reachable over such pairs.

    Around a variant, members within the lower half of the radius are at most
    ``radius`` from every member of the upper half, so each bucket links all
    its members to one of the lower half: no link is lost and no bucket emits
    all its pairs.
    """
    inner, outer = ball(radius // 2), ball(radius - radius // 2)
    near = fps.select("fp", F.posexplode(F.array(*map(F.lit, outer))).alias("k", "mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"),
        (F.col("k") < len(inner)).alias("inner"))
    hub = F.min(F.when(F.col("inner"), F.col("fp"))).over(Window.partitionBy("variant"))
    return (near.select(F.col("fp").alias("a"), hub.alias("b")).where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` for every row;
    component_id is the smallest doc_id reachable over links, the row's own
    included; root is the component's key (a fingerprint of it)."""
    marked = stored(fingerprints(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                    F.xxhash64(text).alias("text_hash")),
        shingle=shingle, keep=("doc_id", "text_hash")), "simhash-fp")
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(links(fps.select("fp"), radius))
    parts = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(parts.join(least, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows of ``docs``, all columns, one for each component: that of the
    smallest doc_id (null last), of equal doc_ids that of the least text hash,
    and of rows equal in both any one."""
    found = near_duplicates(docs, doc_id, text, shingle, radius)
    kept_id, kept_hash, kept_n = fresh(docs.columns, "__kept_id", "__kept_hash", "__kept_n")
    # counts per (component, id, text) first: a component may hold a third of all rows
    best = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash", "n")).alias("k")
    kept = (found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("root").agg(best)
            .select(F.col("k.doc_id").alias(kept_id), F.col("k.text_hash").alias(kept_hash), F.col("k.n").alias(kept_n)))
    rows = docs.join(kept, F.col(doc_id).eqNullSafe(F.col(kept_id)) & (F.xxhash64(text) == F.col(kept_hash)))
    once = rows.where(F.col(kept_n) == 1)
    again = rows.where(F.col(kept_n) > 1).dropDuplicates([kept_id, kept_hash])
    return once.unionByName(again).select(*[F.col(f"`{c}`") for c in docs.columns])
