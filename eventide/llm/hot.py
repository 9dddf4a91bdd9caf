"""Left join with a table of one row for each group, safe for hot groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_HOT = 10_000      # rows: no smaller group is hot
MOST_HOT = 100_000      # groups: there are never more hot ones


def attach(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int, spread: Column) -> DataFrame:
    """``rows`` with the other columns of ``groups`` (NULL for no group; NULL
    keys are equal).  ``groups`` has one row for each key and in ``size`` the
    number of its rows; ``total`` is the number of all rows.

    Groups of more than ``total / MOST_HOT`` rows (and ``LEAST_HOT``) are
    fewer than ``MOST_HOT``: these are broadcast, and their rows go on spread
    out by the hash of ``spread``.  The other groups meet their rows in a
    join that the optimizer plans by their stored size."""
    added = [c for c in groups.columns if c not in on]
    from_ = max(LEAST_HOT, total // MOST_HOT)

    def renamed(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(f"{mark}{k}") for k, c in enumerate(on + added)])

    def meets(mark: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"{mark}{k}")) for k, c in enumerate(on)])

    at = len(on) + added.index(size)
    hot, rest = renamed(groups.where(F.col(size) > from_), "__hot"), renamed(groups.where(F.col(size) <= from_), "__cool")
    is_hot = F.col(f"__hot{at}").isNotNull()
    met = rows.join(F.broadcast(hot), meets("__hot"), "left").withColumn(
        "__salt", F.when(is_hot, F.xxhash64(spread).bitwiseAND(0x3FFFFFFF) + 1).otherwise(F.lit(0).cast("long")))
    met = met.join(rest.withColumn("__zero", F.lit(0).cast("long")), (F.col("__salt") == F.col("__zero")) & meets("__cool"), "left")
    both = [F.coalesce(f"__hot{k}", f"__cool{k}").alias(c) for k, c in enumerate(on + added) if c in added]
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], *both)
