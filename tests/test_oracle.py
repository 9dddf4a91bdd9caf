"""Every registered query against its DuckDB SQL at sf0.01 (the driver's
correctness gate).  Queries without SQL must at least run."""

import pytest

from conftest import SF01, SF001
from eventide.plans.catalog import oracle_queries, spark_queries
import os, sys  # noqa: E401
sys.path.insert(0, os.path.dirname(__file__))
from oracle_check import compare  # noqa: E402

NAMES = sorted(spark_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SF01, [name], verbose=False)
    assert rep[name] == "OK" or (name not in oracle_queries() and rep[name].startswith("rows-only"))


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert df.columns == ["id", "window_end", "avg_temp_c"]
    assert SF001 in e.SMOKE_DIR
