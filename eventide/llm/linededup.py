"""Cross-site line dedup by distinct-site spread, in DataFrame operations only.

Every line's hash gets a HyperLogLog sketch of the sites it stands on; partial
sketches merge by aggregation.  Lines whose estimate is clearly over or under
``min_sites`` are decided by it; those within the sketch's error of it get an
exact distinct count.  Lines on at least ``min_sites`` sites are boilerplate
and leave every document.

A line is what stands between newlines, without spaces, tabs and carriage
returns around it; empty lines stay and never count.  Cases: a null text stays
null and has no lines; a null site counts for no line, its documents lose
boilerplate like others; a document may lose all lines and stays as an empty
text; rows repeat as they come; an empty table gives no rows; further columns
are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm._text import fresh
from eventide.llm.components import stored

MIN_SITES = 10
LG_K = 12               # 4096 registers
ERRORS = 4              # standard errors of a sketch that count as near


def lines_of(text):
    return F.split(text, "\n")


def line_hash(line):
    """Hash of a line without the blanks around it; null for an empty one."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """``(h, site)`` rows -> ``(h)`` of the lines on ``min_sites`` sites or more."""
    spread = lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch")).select(
        "h", F.hll_sketch_estimate("sketch").alias("sites"))
    margin = ERRORS * 1.04 / 2 ** (lg_k / 2)
    likely = stored(spread.where(F.col("sites") >= min_sites * (1 - margin) - 1), "line-spread")
    sure = likely.where(F.col("sites") > min_sites * (1 + margin) + 1).select("h")
    near = likely.where(F.col("sites") <= min_sites * (1 + margin) + 1).select("h")
    exact = (lines.where("site IS NOT NULL").join(near, "h", "left_semi").distinct()
             .groupBy("h").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites).select("h"))
    return sure.union(exact)


def clean(docs: DataFrame, site: str = "source", doc_id: str = "doc_id", text: str = "text",
          min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """``docs`` without boilerplate lines, and ``n_lines`` before and
    ``n_dropped``; columns of these names are replaced."""
    body = F.col(f"`{text}`")
    drop, own, of_id, of_text = fresh(docs.columns, "__drop", "__hash", "__id", "__of")
    hashes = F.filter(F.array_distinct(F.transform(lines_of(body), line_hash)), lambda h: h.isNotNull())
    hashed = docs.where(body.isNotNull()).select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(body).alias("text_hash"),
        F.col(f"`{site}`").cast("string").alias("site"), hashes.alias("hs"))
    seen = stored(hashed.select("id", "text_hash", "site", F.explode("hs").alias("h")), "lines")
    common = stored(boilerplate(seen.select("h", "site"), min_sites, lg_k), "boilerplate")
    drops = (seen.select("id", "text_hash", "h").join(common, "h").groupBy("id", "text_hash")
             .agg(F.collect_set("h").alias(drop)))            # at most the lines of one text
    mine = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(*[F.col(f"`{c}`") for c in mine], F.xxhash64(body).alias(own))
    met = rows.join(drops.select(F.col("id").alias(of_id), F.col("text_hash").alias(of_text), drop),
                    F.col(f"`{doc_id}`").eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_text)), "left")
    gone = F.coalesce(drop, F.array().cast("array<bigint>"))
    held = F.filter(lines_of(body), lambda line: ~F.coalesce(F.array_contains(gone, line_hash(line)), F.lit(False)))
    kept = F.when(F.col(drop).isNull(), body).otherwise(F.array_join(held, "\n"))
    before = F.coalesce(F.size(lines_of(body)), F.lit(0))
    before = F.when(body.isNull(), 0).otherwise(before)
    after = F.when(F.col(drop).isNull(), before).otherwise(F.size(held))
    return met.select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in mine],
                      before.alias("n_lines"), (before - after).alias("n_dropped"))
