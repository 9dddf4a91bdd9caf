import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers
from eventide.llm import feast, hot, vector_codes as C, whiten as W
from eventide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def vector_rows(n=300, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, dim))
    rows = [(k, (middle[k % 6] + 0.05 * rng.normal(size=dim)).astype(np.float32).tolist(), k % 4) for k in range(n)]
    rows += [(1000 + k, [0.25] * dim, None) for k in range(200)]                     # equal vectors
    rows += [(7, rows[7][1], 3), (7, rows[7][1], 3), (None, rows[9][1], None), (None, None, 1), (2000, None, 1), (2001, [], 1),
             (2002, [1.0] * (dim - 1), 2), (2003, [NAN] + [0.0] * (dim - 1), 2), (2004, [INF] * dim, 2), (2005, [-INF] * dim, None),
             (2006, [None] + [0.0] * (dim - 1), 1), (2007, [0.0] * dim, 1), (2008, [-0.0] * dim, 1), (2009, [1e30] + [0.0] * (dim - 1), 9)]
    return rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return helpers.write(tmp_path_factory.mktemp("vectors"), embeddings=vector_rows()[:-1])


def taken(rows, dim=8):
    return [r for r in rows if r[1] is not None and len(r[1]) == dim and all(x is not None and np.isfinite(x) for x in r[1])]


# ---------------------------------------------------------------- codes

def test_codes_equal_sql(spark, folder):
    assert helpers.same_as_sql(spark, SF, "op13_vector_codes") > 0
    assert helpers.same_as_sql(spark, folder, "op13_vector_codes") == len(taken(vector_rows()[:-1]))


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 3), (3, 2), (4, 1), (5, 2)])
def test_hilbert_curve_visits_every_cell_by_unit_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = C.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_shortlists_lose_no_nearest_entry():
    rng = np.random.default_rng(5)
    for spread in (1, 20, 4000):
        book = rng.integers(-1000, 1000, (40, 3))
        book[7] = book[3]                                   # a tie, to be won by the smaller number
        x = rng.integers(-1000, 1000, 3) + rng.integers(-spread, spread + 1, (60, 3))
        among = C.shortlist(x.min(0), x.max(0), book)
        d = ((x[:, None, :] - book) ** 2).sum(2)
        entry, error = C.nearest(x, book, among)
        assert (entry == d.argmin(1)).all() and (error == d.min(1)).all()
    near = C.shortlist(book[5], book[5], book)
    assert list(near) == [5]


def test_large_numbers_are_exact():
    x = np.array([[1 << 24, -(1 << 24)], [(1 << 24) - 1, 5]])
    book = np.array([[-(1 << 24), 1 << 24], [(1 << 24) - 2, 5]])
    entry, error = C.nearest(x, book, np.arange(2))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in book] for r in x]
    assert [list(map(int, (i, e))) for i, e in zip(entry, error)] == [[min(range(2), key=w.__getitem__), min(w)] for w in want]


def plain_codes(rows, parts, entries, rounds, dim=8):
    kept = taken(rows, dim)
    q = [[int(np.floor(min(max(1024 * float(x), -2.0 ** 24), 2.0 ** 24))) for x in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, q[k]))[:entries]
    cut = [(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]
    books = [[q[k][a:b] for k in order] for a, b in cut]

    def choose(vec, book):
        d = [sum((x - y) ** 2 for x, y in zip(vec, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, (a, b) in enumerate(cut):
            mine = [choose(v[a:b], books[p])[0] for v in q]
            for e in set(mine):
                got = [v[a:b] for v, m in zip(q, mine) if m == e]
                books[p][e] = [sum(c) // len(got) for c in zip(*got)]
    found = [[choose(v[a:b], books[p]) for p, (a, b) in enumerate(cut)] for v in q]
    return sorted((str(r[0]), tuple(e for e, _ in f), sum(d for _, d in f)) for r, f in zip(kept, found)), books


@pytest.mark.parametrize("parts,entries,block", [(3, 5, 16), (2, 300, 1), (8, 3, 4096), (1, 40, 64)])
def test_codes_equal_plain_loops(spark, parts, entries, block):
    rows = vector_rows(120)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    codes, book = C.encode(df, parts=parts, entries=entries, rounds=3, block_rows=block)
    want, books = plain_codes(rows, parts, entries, 3)
    assert sorted((str(r["vec_id"]), tuple(r["entries"]), r["error"]) for r in codes.collect()) == want
    assert [b.tolist() for b in book.books] == books


def test_label_errors_of_hot_labels(spark, monkeypatch):
    monkeypatch.setattr(hot, "LEAST_HOT", 50)
    monkeypatch.setattr(hot, "MOST_HOT", 4)
    codes = spark.range(1000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3 + 7).when(
        F.col("id") % 2 == 0, F.col("id")).alias("label"), F.lit("00").alias("code"), F.col("id").alias("error"))
    found = C.with_label_errors(codes).collect()
    want = {}
    for r in found:
        want[r["label"]] = want.get(r["label"], 0) + r["error"]
    assert len(found) == 1000 and all(r["label_error"] == want[r["label"]] for r in found)


def test_codes_of_empty_tables_and_clashing_columns(spark, tmp_path):
    assert QUERIES["op13_vector_codes"](spark, helpers.write(tmp_path)).count() == 0
    df = spark.createDataFrame(vector_rows(20), "vec_id long, embedding array<float>, label int")
    plain, _ = C.encode(df)
    extra, _ = C.encode(df.selectExpr("*", "1 AS row", "'x' AS part", "2 AS x", "3 AS code", "4 AS error", "5 AS __salt"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, extra.collect()))


# ---------------------------------------------------------------- whitening

SPECTRA = [lambda d: np.linspace(1, 2, d), lambda d: np.ones(d), lambda d: np.r_[np.zeros(d - d // 3), np.ones(d // 3) * 5],
           lambda d: 10.0 ** -np.arange(d), lambda d: np.r_[1, 1 + 1e-10, np.linspace(0, 1e-3, d)][:d],
           lambda d: np.repeat(np.arange(1, d + 1), 3)[:d] / 7]


@pytest.mark.parametrize("d", [1, 2, 7, 40])
@pytest.mark.parametrize("spectrum", SPECTRA)
def test_contour_integration_finds_every_pair(d, spectrum):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    a = (q * spectrum(d)) @ q.T
    a = (a + a.T) / 2
    want = np.linalg.eigvalsh(a)[::-1]
    values, vectors = feast.largest(a, 16)
    assert len(values) == min(16, int((want > np.abs(a).sum(1).max() * d * 1e-14).sum()))
    assert np.allclose(values, want[:len(values)], rtol=0, atol=1e-14 * want[0] * 10)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13
    assert np.abs(a @ vectors - vectors * values).max(initial=0) <= 1e-13 * want[0] * 10


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 10, 50):
        a = rng.normal(size=(d, d))
        a += a.T
        a[0, 0] = 0
        values = np.linalg.eigvalsh(a)
        for shift in rng.normal(size=8) * np.abs(values).max():
            assert feast.above(a, shift) == (values > shift).sum()
    assert feast.above(np.array([[0.0, 1], [1, 0]]), 0.0) == 1


def plain_whitening(rows, dim):
    kept = taken(rows, dim)
    x = [[int(np.floor(min(max(64 * float(c), -2.0 ** 24), 2.0 ** 24))) + 1_000_000 for c in r[1]] for r in kept]
    fit = np.array(sorted(set(map(tuple, x))))
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    centred = fit - np.array(sums) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    w = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
    dev = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return kept, n, dev, w, values / np.trace(cov)


def test_whitening_equals_plain_numpy(spark):
    rows = vector_rows(300, dim=20)[:-1]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 AS x", "2 AS cell", "3 AS component", "4 AS n").repartition(7)
    got = W.whiten(df).toPandas()
    kept, n, dev, w, share = plain_whitening(rows, 20)
    assert len(got) == 16 * len(kept) and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    assert sorted(got["deviation"][got["component"] == 1]) == sorted(dev)
    assert np.allclose(got.groupby("component")["explained"].first().to_numpy(), share, rtol=1e-9)
    ids = {r[0]: k for k, r in enumerate(kept) if r[0] is not None}
    rest = got.dropna(subset=["vec_id"])
    ours = rest["whitened"].to_numpy()
    theirs = w[[ids[v] for v in rest["vec_id"]], rest["component"].to_numpy() - 1]
    sign = np.array([np.sign((ours * theirs)[rest["component"] == c].sum()) for c in range(1, 17)])
    assert np.abs(ours - theirs * sign[rest["component"].to_numpy() - 1]).max() < 1e-7


def test_whitening_does_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    def run(parts):
        return W.whiten(df.repartition(parts)).toPandas().sort_values(["vec_id", "component"]).reset_index(drop=True)
    one, two = run(1), run(7)
    exact = ["vec_id", "component", "n", "deviation", "explained"]
    assert one[exact].equals(two[exact]) and np.abs(one["whitened"] - two["whitened"]).max() < 1e-9


def test_whitening_of_awkward_tables(spark, tmp_path):
    assert QUERIES["op11_whitening"](spark, helpers.write(tmp_path)).count() == 0
    def found(rows):
        return W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert found([(1, [1.0, 2.0])]) == [] and found([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == [] and found([(1, []), (2, [])]) == []
    one = found([(1, [0.0, 3.0]), (2, [1.0, 3.0]), (None, [1.0, 3.0]), (4, None), (5, [NAN, 1.0]), (6, [1.0])])
    assert sorted(str(r["vec_id"]) for r in one) == ["1", "2", "None"] and {r["component"] for r in one} == {1}
    assert {r["n"] for r in one} == {2} and {r["deviation"] for r in one} == {64 ** 2} and {abs(round(r["whitened"], 12)) for r in one} == {1.0}
    far = found([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.5, 0.0])])
    assert len(far) == 6 and {r["deviation"] is None for r in far} == {False}
