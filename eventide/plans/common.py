"""Shared inputs for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import ensure_utc
from eventide.sources.tables import load, readings


def events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    ensure_utc(spark)
    return readings(load(spark, sf_dir, "events"), keep)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return load(spark, sf_dir, name)


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# DuckDB snippets shared by the oracle SQL
READINGS_SQL = ("(SELECT user_id AS id, ts, value AS temperature, event_id AS seq, event_type "
                "FROM events)")
