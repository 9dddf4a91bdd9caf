"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import os
import sys

import pyarrow as pa
import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
                  ("n_chars", pa.int64())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
BENCH = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
VECS = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
SCHEMAS = {"documents": DOCS, "labels": LABELS, "benchmark": BENCH, "pages": PAGES, "embeddings": VECS}

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"

AWKWARD_TEXTS = [
    None, "", " \n\t ", "!!! 123 ???", "One", "one two", "ONE TWO THREE", "Ünïcode Wörds ünïcode",
    f"Before {ITEM.upper()} after.", "alpha beta gamma, delta! epsilon zeta eta theta iota kappa",
    "Released under the MIT License. All rights reserved.", "cc by nc cc BY-NC Apache License, Version 2.0",
    "the same line\nthe same line\n\nother line", "same text as another", "same text as another",
    "nul \x00 byte and \x7f delete", "very long " + "word " * 30_000,
]


def docs_rows() -> list[tuple]:
    rows = [(k, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None)
            for k, t in enumerate(AWKWARD_TEXTS)]
    rows += [rows[6], rows[6], (6, "other text of the same id", "de", "s1", 3), (None, "no id here", "en", "s2", 1),
             (None, None, None, None, None)]
    return rows


def write(folder, **tables) -> str:
    """Parquet tables of a folder; those not given are empty."""
    for name, schema in SCHEMAS.items():
        rows = tables.get(name, [])
        cols = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
        pq.write_table(pa.Table.from_arrays(cols, schema=schema), os.path.join(str(folder), f"{name}.parquet"))
    return str(folder)


def same_as_sql(spark, folder: str, name: str, places: int = 6) -> int:
    """The query's rows and its SQL's on a folder are equal; how many."""
    import duckdb
    from eventide.llm.queries import ORACLES, QUERIES
    from oracle_check import rows_of

    con = duckdb.connect()
    for t in SCHEMAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    ours, theirs = QUERIES[name](spark, folder).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)
    return len(ours)
