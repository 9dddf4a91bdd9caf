"""Licence scan by diagonal voting, in DataFrame operations only.

Hashes of all rolling word k-grams of the texts are joined to the places of
the same k-grams in the templates (a fixed, broadcast table).  A match at text
word i and template word j votes for diagonal i - j, where the template would
begin.  Votes are summed by text, template and diagonal as a bit set of
template places, diagonals a few words apart (words put in or left out) are
merged, and a span is verified by the share of the template's words its votes
cover.  Matched k-grams are compared word by word, so hashes only find them.

A phrase marked ``base`` counts a place only where all its words stand
consecutively: every vote of one diagonal.

Cases: a null text is empty; texts of fewer words than a k-gram match nothing;
rows that repeat return repeated, as do rows that share a doc_id with other
text; null doc_ids are kept; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm._text import NOT_WORD, ascii_lower
from eventide.llm.components import stored

K = 3                   # words of a k-gram
LEAST_COVER = 0.8       # of a template's words, for a span to count
MERGE_WITHIN = 10       # diagonals merge if at most 1/10 of the template apart
MOST_WORDS = 62         # of a template: its places are bits of one number


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# The contract's phrases, then usual notices (lower case, words only).
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("all-rights-reserved", "all rights reserved"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
                    "gnu general public license as published by the free software foundation"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files the software to deal in the software without restriction"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except "
                         "in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
)


def gram_hash(words, at):
    """Hash of the k words from 0-based place ``at``."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(K)])


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """``(h, template, place, gram)``: every k-gram of every template."""
    for t in templates:
        if not K <= len(t.words) <= MOST_WORDS:
            raise ValueError(f"a template has {K} to {MOST_WORDS} words: {t.text!r}")
    rows = [F.struct(F.lit(n).alias("template"), F.lit(p).alias("place"),
                     F.array(*map(F.lit, t.words[p:p + K])).alias("gram"))
            for n, t in enumerate(templates) for p in range(len(t.words) - K + 1)]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("h", gram_hash(F.col("gram"), F.lit(0)))


def votes(docs: DataFrame, templates: tuple[Template, ...], doc_id: str, text: str) -> DataFrame:
    """One row for each text, template and diagonal: the template places that
    voted (bits) and the number of votes; and for each text one row of
    template -1, whose votes are the equal rows of that text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.filter(F.split(ascii_lower(body), NOT_WORD), lambda w: w != "")
    kind = "array<struct<n_words:int,at:int,h:bigint,words:array<string>>>"

    def grams(w):
        """The rows of a text: one with place 0 for itself, one for each
        k-gram.  Each has all it needs, so no row carries the whole text."""
        n = F.size(w)
        itself = F.array(F.struct(n, F.lit(0), F.lit(0).cast("long"), F.array().cast("array<string>"))).cast(kind)
        every = F.transform(F.sequence(F.lit(0), n - K), lambda i: F.struct(n, i + 1, gram_hash(w, i), F.slice(w, i + 1, K))).cast(kind)
        return F.concat(itself, F.when(n >= K, every).otherwise(F.array().cast(kind)))

    # bound as a lambda's variable, a text is split once, not once for each of its words
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("text_hash"),
                       F.get(F.transform(F.array(words), grams), F.lit(0)).alias("grams"))
    known = template_grams(docs.sparkSession, templates).unionByName(
        docs.sparkSession.range(1).select(F.lit(-1).alias("template"), F.lit(0).alias("place"),
                                          F.array().cast("array<string>").alias("gram"), F.lit(0).cast("long").alias("h")))
    # no text is without rows; "outer" keeps the optimizer from testing that by splitting it again
    at = rows.select("doc_id", "text_hash", F.inline_outer("grams"))
    found = at.join(F.broadcast(known), "h").where(
        F.when(F.col("template") < 0, F.col("at") == 0).otherwise((F.col("at") > 0) & (F.col("words") == F.col("gram"))))
    return found.select(
        "doc_id", "text_hash", "n_words", "template",
        F.when(F.col("template") >= 0, F.col("at") - 1 - F.col("place")).alias("diagonal"),
        F.expr("shiftleft(1L, place)").alias("bit"),
    ).groupBy("doc_id", "text_hash", "n_words", "template", "diagonal").agg(
        F.bit_or("bit").alias("places"), F.count(F.lit(1)).alias("n"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, doc_id: str = "doc_id",
         text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts ``(doc_id, text_hash, n_words, n)`` (n equal rows each) and
    verified or base spans ``(doc_id, text_hash, n_words, template, label,
    begin, last, cover, n_base, first_base, last_base)``; begin and last are
    the first and last merged diagonal, that is where the template begins."""
    cast = stored(votes(docs, templates, doc_id, text), "licence-votes")
    key = ["doc_id", "text_hash", "n_words"]
    about = docs.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("template"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
                 F.lit(len(t.words)).alias("length"), F.lit((1 << (len(t.words) - K + 1)) - 1).cast("long").alias("whole"))
        for n, t in enumerate(templates)])))
    line = Window.partitionBy(*key, "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(line)
    cut = F.when(step * MERGE_WITHIN <= F.col("length"), 0).otherwise(1)
    exact = F.col("base") & (F.col("places") == F.col("whole"))
    runs = cast.where("template >= 0").join(F.broadcast(about), "template").withColumn("cut", cut).withColumn(
        "run", F.sum("cut").over(line))
    spans = runs.groupBy(*key, "template", "run", "label", "base", "length").agg(
        F.min("diagonal").alias("begin"), F.max("diagonal").alias("last"), F.bit_or("places").alias("places"),
        F.sum(exact.cast("long")).alias("n_base"), F.min(F.when(exact, F.col("diagonal"))).alias("first_base"),
        F.max(F.when(exact, F.col("diagonal"))).alias("last_base"))
    covered = F.expr(" | ".join(f"shiftleft(places, {i})" for i in range(K)))
    spans = spans.withColumn("cover", F.bit_count(covered) / F.col("length")).where(
        (F.col("n_base") > 0) | ~F.col("base") & (F.col("cover") >= LEAST_COVER))
    return cast.where("template < 0").select(*key, "n"), spans.drop("run", "places", "base", "length")


def report(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """One row for each row of the documents scanned."""
    key = ["doc_id", "text_hash", "n_words"]

    def joined(labels):
        return F.concat_ws(",", F.array_sort(F.collect_set(labels)))

    by_text = spans.groupBy(*[F.col(k).alias(f"of_{k}") for k in key]).agg(
        F.sum("n_base").alias("n_base"), F.min("first_base").cast("long").alias("first_word"),
        F.max("last_base").cast("long").alias("last_word"),
        joined(F.when(F.col("n_base") > 0, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"), F.max("cover").alias("score"))
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in key]
    return (texts.join(by_text, same, "left")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                    F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")))
