"""User function surface: the slow path for logic with no expression.

Prefer Column expressions; when Python is needed, these run it per Arrow
batch (pandas), never per row.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def map_partitions_with_setup(df: DataFrame, schema: str,
                              open_fn: Callable[[], object],
                              fn: Callable[[object, pd.DataFrame], pd.DataFrame],
                              close_fn: Callable[[object], None] | None = None) -> DataFrame:
    """Rich function: ``open`` once per task (connections, models), ``fn``
    per Arrow batch, ``close`` at the end of the task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        ctx = open_fn()
        tc = TaskContext.get()
        try:
            for b in batches:
                out = fn(ctx, b)
                if tc is not None and "subtask" in schema:
                    out = out.assign(subtask=tc.partitionId())
                yield out
        finally:
            if close_fn:
                close_fn(ctx)
    return df.mapInPandas(run, schema)


def flat_map_pandas(df: DataFrame, schema: str,
                    fn: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """flatMap with a Collector: ``fn`` returns 0..n output rows per input
    batch."""
    return df.mapInPandas(lambda it: (fn(b) for b in it), schema)


def udaf(fn: Callable[[pd.Series], object], return_type: str):
    """User aggregate (ReduceFunction / AggregateFunction with arbitrary
    logic): a grouped-aggregate pandas UDF, ``fn(values) -> scalar``.

    Slow path: a pandas UDAF has no partial aggregation, so every value of
    a group reaches one task.  Use it for per-window groups, and expression
    aggregates (sum/min/max/avg/max_by, partial-aggregated) for anything
    keyed by a possibly hot key alone.
    """
    from pyspark.sql import functions as F

    def agg(v: pd.Series) -> float:  # the annotation selects GROUPED_AGG
        return fn(v)

    return F.pandas_udf(agg, return_type)


def udtf_flat_map(df: DataFrame, table_fn, *args) -> DataFrame:
    """flatMap through a Python UDTF (``@udtf`` class with ``eval`` yielding
    0..n rows), lateral-joined to each input row."""
    return df.lateralJoin(table_fn(*[a.outer() for a in args]))


def word_splitter():
    """Example UDTF: one row per space-separated word (JVM split rules)."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="word: string")
    class SplitWords:
        def eval(self, line: str):
            if line is None:
                return
            parts = line.split(" ")
            while len(parts) > 1 and parts[-1] == "":
                parts.pop()
            if parts == [""] and line != "":
                return
            for w in parts:
                yield (w,)

    return SplitWords
