"""Growing lists (a rolling reduce that concatenates lists), kept as deltas.

Row *n* of a key stands for the concatenation of the key's first *n* lists, so
writing the lists out is quadratic.  Kept instead are, for every row, how many
elements its list has (a skew-safe scan), and every element once, in pieces of
:data:`PIECE` neighbouring elements.  :func:`list_view` puts lists together for
those rows that are really read.

Cases: NULL keys are one key; a NULL list adds nothing; NULL elements stay;
rows equal in time and tiebreak follow the order of their lists' hashes (lists
with maps have none: there the tiebreak must be unique).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.scan import Scan, same, scan

PIECE = 1024        # elements


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _has_order(df: DataFrame, column: str) -> bool:
    return "map<" not in df.schema[column].dataType.simpleString()


def _size(items: str) -> Column:
    return F.when(F.col(items).isNull(), 0).otherwise(F.size(items)).cast("long")


def list_rows(df: DataFrame, key, items: str, ts: str = "ts", seq: str = "seq", upto: str = "upto",
              chunk=None) -> DataFrame:
    """``df`` with ``upto``: how many elements the key's list has after the row."""
    order = [seq]
    if _has_order(df, items):
        df, order = df.withColumn("__tie", F.xxhash64(items)), [seq, "__tie"]
    return scan(df, _keys(key), ts, order, [Scan(upto, "sum", _size(items))], chunk=chunk).drop("__tie")


def list_pieces(rows: DataFrame, key, items: str, upto: str = "upto", piece: int = PIECE) -> DataFrame:
    """``(key..., __piece, __items)``: every element of the rows of
    :func:`list_rows` once, ``piece`` neighbours together."""
    keys = _keys(key)
    each = rows.select(*keys, (F.col(upto) - _size(items)).alias("__from"), F.posexplode(items).alias("__nth", "v"))
    each = each.select(*keys, (F.col("__from") + F.col("__nth")).alias("at"), "v")
    held = F.collect_list(F.struct("at", "v"))
    ordered = F.sort_array(held) if _has_order(rows, items) else F.array_sort(held, lambda a, b: (a["at"] - b["at"]).cast("int"))
    return each.groupBy(*keys, F.floor(F.col("at") / piece).cast("long").alias("__piece")).agg(
        F.transform(ordered, lambda e: e["v"]).alias("__items"))


def list_view(rows: DataFrame, pieces: DataFrame, key, items: str, out: str, upto: str = "upto",
              piece: int = PIECE) -> DataFrame:
    """``rows`` (any of :func:`list_rows`) with the whole list of each as
    ``out``.  Earlier pieces are joined once for each piece, not for each row;
    a row takes them and the beginning of its own piece."""
    keys = _keys(key)
    # only the pieces that rows end in are put together with those before them
    last = F.floor((F.col(upto) - 1) / piece).cast("long")
    asked = rows.where(F.col(upto) > 0).select(*keys, last.alias("__piece")).distinct()
    parts = asked.select(*keys, F.col("__piece").alias("__upto"), F.explode(F.sequence(F.lit(0).cast("long"), "__piece")).alias("__piece"))
    found = parts.alias("l").join(pieces.alias("r"), same([*keys, "__piece"])).select("l.*", "r.__items")
    held = F.collect_list(F.struct("__piece", "__items"))
    ordered = (F.sort_array(held) if _has_order(rows, items)
               else F.array_sort(held, lambda a, b: (a["__piece"] - b["__piece"]).cast("int")))
    whole = found.groupBy(*keys, F.col("__upto").alias("__piece")).agg(
        F.flatten(F.transform(ordered, lambda e: e["__items"])).alias("__whole"))
    left = rows.withColumn("__piece", last)
    kept = [F.col(f"l.`{c}`") for c in rows.columns if c != out]
    own = F.slice(F.col("r.__whole"), F.lit(1), F.col(f"l.`{upto}`").cast("int"))
    kind = rows.schema[items].dataType.simpleString()
    return left.alias("l").join(whole.alias("r"), same([*keys, "__piece"]), "left").select(
        *kept, F.coalesce(own, F.array().cast(kind)).alias(out))
