import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers
from eventide.llm import ann as A
from eventide.llm.queries import QUERIES


def brute(rows, queries, k=10):
    """{(query, rank): (id, distance)} over usable (id, vector) rows."""
    def good(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    out = {}
    held = {}
    for i, v in rows:
        if i is not None and good(v):
            held.setdefault(i, set()).add(tuple(np.float32(v).astype(float)))
    for q in sorted({i for i, v in queries if i is not None and good(v)}):
        near = {}
        for i, vs in held.items():
            if i != q:
                d = [float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum())) for a in held[q] for b in vs if len(a) == len(b)]
                if d:
                    near[i] = min(d)
        for rank, (i, d) in enumerate(sorted(near.items(), key=lambda x: (x[1], x[0]))[:k], 1):
            out[q, rank] = (i, d)
    return out


def found(df):
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in df.collect()}


def recall(got, want):
    ids = lambda x: {(q, v[0]) for (q, _), v in x.items()}
    return len(ids(got) & ids(want)) / max(1, len(ids(want)))


def test_awkward_rows(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(size=4).tolist(), 0) for k in range(205)]
    same = rows[7][1]
    rows += [(300 + k, same, 1) for k in range(40)] + [(100, same, 2), rows[200], rows[200], (None, same, 0)]
    rows += [(400, None, 0), (500, [0.0] * 4, 0), (600, [float("nan"), 1, 1, 1], 0), (700, [float("inf"), 1, 1, 1], 0),
             (800, [None, 1.0, 1.0, 1.0], 0), (900, [1.0, 2.0], 0), (1000, [1.0, 2.5], 0), (1100, [], 0)]
    folder = helpers.write(tmp_path, embeddings=rows)
    got = found(QUERIES["op7_nearest_neighbours"](spark, folder))
    want = brute([r[:2] for r in rows], [r[:2] for r in rows if r[0] is not None and r[0] % 100 == 0])
    assert {k for k in got} == {k for k in want}
    assert recall(got, want) >= 0.95
    for key, (i, d) in got.items():
        if want[key][0] == i:
            assert d == pytest.approx(want[key][1], abs=1e-12)
    assert got[900, 1] == (1000, 0.5) and (900, 2) not in got
    assert [got[100, r][0] for r in range(1, 11)] == [7, *range(300, 309)]      # ties by id


@pytest.mark.parametrize("scale", [0.0, 1.0])
def test_recall_on_hard_vectors(spark, scale):
    """No clusters, many dimensions; with norms all equal and widely spread."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * np.exp(scale * rng.normal(size=(3000, 1)))
    rows = [(int(k), list(map(float, np.float32(v)))) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(A.search(df, df.where("vec_id % 100 = 0"), segment_rows=800, block_rows=13))
    want = brute(rows, [r for r in rows if r[0] % 100 == 0])
    assert len(got) == len(want) and recall(got, want) >= 0.9


def test_easy_neighbours_need_few_candidates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 32))
    x = np.concatenate([x, x + 0.01 * rng.normal(size=x.shape)])
    f = A.Forest(np.arange(8000), x, 0.0)
    at, far = f.search(np.arange(20), x[:20], 1, 0.05)
    assert all(4000 + q in a for q, a in enumerate(at))
    assert np.mean([len(a) for a in at]) < 200


def test_sf_recall_and_empty(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0])
    assert recall(found(QUERIES["op7_nearest_neighbours"](spark, sf)), want) >= 0.9
    assert QUERIES["op7_nearest_neighbours"](spark, helpers.write(tmp_path)).count() == 0
