"""Rows whose vector takes part in whole-number work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Multiplied components are held within this, so that the squares of whole
#: numbers and their sums fit 64 bits; usual embeddings are nowhere near.
MOST = float(1 << 24)


def finite(vector: str):
    """Condition: the vector is not null and all its components are numbers."""
    v = F.col(f"`{vector}`").cast("array<double>")
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def floors(vector: str, factor: int, plus: int = 0):
    """Whole numbers ``floor(factor * x) + plus`` of a vector's components."""
    held = lambda x: F.least(F.greatest(x, F.lit(-MOST)), F.lit(MOST))
    return F.transform(F.col(f"`{vector}`").cast("array<double>"),
                       lambda x: F.floor(held(x * F.lit(float(factor)))).cast("long") + F.lit(plus).cast("long"))


def commonest_size(rows: DataFrame, vector: str) -> int:
    """The number of components that most vectors have (of equally common
    ones the larger); 0 for an empty table."""
    by_size = rows.groupBy(F.size(f"`{vector}`").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = by_size.orderBy(F.desc("n"), F.desc("size")).first()
    return most["size"] if most else 0
