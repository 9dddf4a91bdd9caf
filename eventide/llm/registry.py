"""Queries ``opN_*`` of this subpackage and their DuckDB SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return put
