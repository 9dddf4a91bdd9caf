"""Registered queries: each name maps to a Spark builder ``(spark, sf_dir)
-> DataFrame`` and, where the semantics are SQL-expressible, the DuckDB
SQL that must return the same rows (the correctness oracle).

Conventions: a reading is ``id = user_id``, ``ts``, ``temperature =
value``, arrival order ``(ts, event_id)``.  Doubles are rounded to 6
places on both sides, times are TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CATALOG: dict[str, "Registered"] = {}


@dataclass
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn):
        CATALOG[name] = Registered(name, fn, sql, ids)
        return fn
    return deco


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v.build for k, v in CATALOG.items()}


def oracle_queries() -> dict[str, str]:
    _load_all()
    return {k: v.sql for k, v in CATALOG.items() if v.sql}


def _load_all():
    # importing the modules registers their queries
    from eventide.plans import (  # noqa: F401
        q_transform, q_rolling, q_windows, q_combine, q_alerts, q_panes,
    )
