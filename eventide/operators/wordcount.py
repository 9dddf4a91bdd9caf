"""Word count (batch: grouped sum; stream: the same plan in update or
complete mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalar import java_split
from eventide.sources.text import text_lines


def word_count(lines: DataFrame, col: str = "line", sep: str = " ") -> DataFrame:
    """``flatMap(split) → map((_, 1)) → groupBy(0).sum(1)``.

    Partial aggregation combines each word map-side, so a very frequent
    word costs one partial row per input partition.
    """
    words = lines.select(F.explode(java_split(F.col(col), sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def document_word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Word count over documents read line by line, as a text file source
    would present them."""
    return word_count(text_lines(docs.select(text_col), text_col), "line")
