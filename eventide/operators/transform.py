"""Record-level operators: map, filter, flatMap, routing and side outputs.

All are narrow (no shuffle) column expressions and run unchanged on
streaming DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalar import java_split


def map_cols(df: DataFrame, **exprs: Column) -> DataFrame:
    """``map``: one row out per row in; named output expressions."""
    return df.select(*[e.alias(n) for n, e in exprs.items()])


def filter_rows(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)


def flat_map_split(df: DataFrame, col: str, sep: str = " ", out: str = "word",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``flatMap(_.split(sep))`` with JVM split semantics (see java_split)."""
    return df.select(*keep, F.explode(java_split(F.col(col), sep)).alias(out))


def route(df: DataFrame, rules: dict[str, Column], out: str = "labels") -> DataFrame:
    """Split into named outputs: ``labels`` holds every output name whose
    rule is true (a row may go to several outputs or none)."""
    arr = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return df.withColumn(out, F.filter(arr, lambda x: x.isNotNull()))


def select_outputs(routed: DataFrame, names: list[str], labels: str = "labels") -> DataFrame:
    """``select("low", "high")``: rows routed to any of ``names``, each once."""
    return routed.where(F.arrays_overlap(F.col(labels), F.array(*[F.lit(n) for n in names])))


def side_split(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Main output where ``cond`` holds, side output for every other row
    (NULL counts as "not main", so no row is lost)."""
    main = df.where(F.coalesce(cond, F.lit(False)))
    side = df.where(~F.coalesce(cond, F.lit(False)))
    return main, side


def union_all(*dfs: DataFrame) -> DataFrame:
    """``union`` of same-typed inputs: UNION ALL by column name, no dedup."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def connect_flat_map(left: DataFrame, right: DataFrame, flat_left: Column, flat_right: Column,
                     tag: str = "src") -> DataFrame:
    """``connect(...).flatMap(f1, f2)``: each side's function gives an array
    of structs, none to many outputs per row; fields are matched by name."""
    sides = [df.select(F.inline(out)).withColumn(tag, F.lit(k))
             for k, (df, out) in enumerate(((left, flat_left), (right, flat_right)), 1)]
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


def connect(left: DataFrame, right: DataFrame, map_left: dict[str, Column],
            map_right: dict[str, Column], tag: str = "src") -> DataFrame:
    """``connect(...).map(f1, f2)``: each side mapped by its own function to
    a common (possibly partial) schema, then unioned with a source tag."""
    a = left.select(*[e.alias(n) for n, e in map_left.items()], F.lit(1).alias(tag))
    b = right.select(*[e.alias(n) for n, e in map_right.items()], F.lit(2).alias(tag))
    return a.unionByName(b, allowMissingColumns=True)
