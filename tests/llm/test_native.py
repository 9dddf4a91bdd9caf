import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers
from eventide.llm import licenses as S, linededup as D, mixing as M, q_mixing, sharding as H, url_filter as U
from eventide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NATIVE = ["op3_license_scan", "op5_mixing", "op6_line_dedup", "op8_url_filter", "op9_sharding"]
ORACLED = [n for n in NATIVE if n != "op5_mixing"]

URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1", "http://www.example.com/en/2?x", "http://a.net/es/#f",
        "http://net/fr/9", "http://com", "http://com/", "http://xcom/", "ftp://a.b.co.uk/p/3.html", "http://h.org/x://y?z=://",
        "http://a.net/esx", "http://b.net/fr/7/", "http://b.net/fr/7/", "://no.org/5"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    pages = [(k, u, None) for k, u in enumerate(URLS)] + [(None, "http://www.example.com/en/4", None), (3, "http://x.org/2", "h")]
    labels = [(k, k % 2, 0) for k in range(8)] + [(2, 1, 1), (3, None, 0), (None, 1, 0), (4, 1, None)]
    return helpers.write(tmp_path_factory.mktemp("native"), documents=helpers.docs_rows(), pages=pages, labels=labels)


@pytest.mark.parametrize("name", ORACLED)
def test_sql_on_sf_and_awkward_rows(spark, folder, name):
    assert helpers.same_as_sql(spark, SF, name) > 0
    assert helpers.same_as_sql(spark, folder, name) > 0


@pytest.mark.parametrize("name", NATIVE)
def test_empty_tables_and_plans_without_python(spark, tmp_path, name):
    assert QUERIES[name](spark, helpers.write(tmp_path)).count() == 0
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


# ------------------------------------------------------------- licences

def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_base_places_equal_brute_force(spark, tmp_path):
    rng = random.Random(2)
    bits = ["under the mit license", "apache license version 2", "cc by nc", "under the", "license", "cc by", "nc", "word"]
    rows = [(k, " ".join(rng.choice(bits) for _ in range(rng.randrange(12))), None, None, None) for k in range(60)]
    got = {r["doc_id"]: r for r in QUERIES["op3_license_scan"](spark, helpers.write(tmp_path, documents=rows)).collect()}
    base = {t.label: t.words for t in S.TEMPLATES if t.base}
    for k, t, *_ in rows:
        w = words(t)
        at = {n: [i for i in range(len(w)) if w[i:i + len(p)] == p] for n, p in base.items()}
        every = sorted(i for v in at.values() for i in v)
        r = got[k]
        assert (r["n_words"], r["n_base"]) == (len(w), len(every))
        assert (r["first_word"], r["last_word"]) == ((every[0], every[-1]) if every else (None, None))
        assert r["base_labels"] == ",".join(sorted(n for n, v in at.items() if v))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))


def test_spans_survive_changed_words(spark):
    whole = next(t for t in S.TEMPLATES if t.label == "mit" and not t.base).words
    put_in = whole[:9] + ["very"] + whole[9:]
    left_out = whole[:12] + whole[14:]
    half = whole[:len(whole) // 2]
    docs = spark.createDataFrame([(k, " ".join(["x"] * 5 + w + ["y"])) for k, w in enumerate([whole, put_in, left_out, half])],
                                 "doc_id long, text string")
    rows = {r["doc_id"]: r for r in S.report(*S.scan(docs)).collect()}
    assert rows[0]["score"] == 1.0 and rows[0]["n_base"] == 0
    assert rows[1]["labels"] == rows[2]["labels"] == "mit" and rows[1]["score"] == 1.0 and 0.8 <= rows[2]["score"] < 1
    assert rows[3]["labels"] == "" and rows[3]["score"] == 0
    with pytest.raises(ValueError):
        S.scan(docs, (S.Template("short", "two words"),))


# ----------------------------------------------------------------- lines

def test_lines_leave_at_the_threshold(spark):
    rows = [(k, f"s{k}", f"own {k}\n common \nrare\n\n" if k < 5 else f"own {k}\ncommon\r") for k in range(10)] \
        + [(20 + k, "s0", "one site") for k in range(30)] + [(99, None, "common\none site"), (100, "s1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n_lines", F.lit("old"))
    got = {r["doc_id"]: r for r in D.clean(docs, min_sites=10).collect()}
    assert got[0]["text"] == "own 0\nrare\n\n" and (got[0]["n_lines"], got[0]["n_dropped"]) == (5, 1)
    assert got[99]["text"] == "one site" and got[100]["text"] is None and got[20]["n_dropped"] == 0
    assert {r["doc_id"]: r["n_dropped"] for r in D.clean(docs, min_sites=11).collect()} == {r[0]: 0 for r in rows}
    assert D.clean(docs, min_sites=5).where("doc_id = 0").first()["text"] == "own 0\n\n"


def test_sketches_decide_only_far_from_the_threshold(spark):
    """Thousands of sites: the estimate errs, the decision does not."""
    lines = spark.range(3000).select(F.explode(F.array(F.lit(1), F.when(F.col("id") < 2999, 2), F.when(F.col("id") < 1500, 3))).alias("h"),
                                     F.col("id").cast("string").alias("site")).where("h IS NOT NULL").withColumn("h", F.col("h").cast("long"))
    assert {r["h"] for r in D.boilerplate(lines, 3000).collect()} == {1}
    assert {r["h"] for r in D.boilerplate(lines, 2999, lg_k=6).collect()} == {1, 2}


# ---------------------------------------------------------------- mixing

def members(spark, n=300, seed=4):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.4, 0.4, 0.4], n)
    return spark.createDataFrame([(k, k, int(rng.integers(0, 400)), int(rng.integers(1, 4)), *map(float, p[k])) for k in range(n)],
                                 "doc_id long, text_hash long, tokens int, copies long, p0 double, p1 double, p2 double")


@pytest.mark.parametrize("targets", [[0.2, 0.5, 0.3], [0.9, 0.05, 0.05]])
def test_rates_meet_targets_and_are_least_squares(spark, targets):
    rows = M.fit_rates(members(spark), targets, tolerance=1e-6, steps=200).toPandas()
    w, p, r = (rows.tokens * rows.copies).to_numpy(float), rows[["p0", "p1", "p2"]].to_numpy(), rows.rate.to_numpy()
    assert (r >= 0).all()
    goal = np.array(targets) * w.sum()
    assert np.abs((w * r) @ p - goal).max() <= 1e-3 * w.sum()


def test_rates_equal_a_plain_projected_gradient(spark):
    """The limit from rates of one is the same with unit steps in numpy."""
    rows = M.fit_rates(members(spark, 80), [0.5, 0.3, 0.2], tolerance=1e-9, steps=120).toPandas()
    w, p = (rows.tokens * rows.copies).to_numpy(float), rows[["p0", "p1", "p2"]].to_numpy()
    r, natural = np.ones(len(rows)), w @ p
    for _ in range(5000):
        r = np.maximum(0, r + p @ ((np.array([0.5, 0.3, 0.2]) * w.sum() - (w * r) @ p) / natural))
    assert np.abs((w * r) @ p - (w * rows.rate.to_numpy()) @ p).max() < 1e-3 * w.sum()


def test_unreachable_targets_get_near(spark):
    flat = members(spark, 50).withColumn("p0", F.lit(0.5)).withColumn("p1", F.lit(0.5)).withColumn("p2", F.lit(0.0))
    rows = M.fit_rates(flat, [0.9, 0.1, 0.0], steps=20).toPandas()
    assert np.allclose(rows.rate, rows.rate.iloc[0]) and 0.5 < rows.rate.iloc[0] < 1.5
    assert M.fit_rates(flat.limit(0), [0.5, 0.5, 0.0]).count() == 0


def test_posteriors_follow_labels_and_rates_act(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for k in range(300):
        d = "ab"[k % 2]
        docs.append((k, " ".join([f"{d}{rng.randrange(5)}" for _ in range(8)] + [f"w{rng.randrange(50)}" for _ in range(20)]), "keep"))
        if k % 3:
            labels.append((k, d))
    docs += [(1000, None, "keep"), (None, "a1 a2", "keep"), (5, docs[5][1], "keep")]
    df = spark.createDataFrame(docs, "doc_id long, text string, tokens string")
    named = spark.createDataFrame(labels + [(7, "other"), (None, "a")], "doc_id long, domain string")
    got = M.memberships(df, named, ["a", "b"]).toPandas()
    assert got.copies.sum() == len(docs) and np.allclose(got.p0 + got.p1, 1)
    sure = got[got.doc_id.notna() & (got.doc_id < 300)]
    assert ((sure.p0 > 0.5) == (sure.doc_id % 2 == 0)).mean() > 0.97
    out = M.mix(df, named, {"a": 0.75, "b": 0.25})
    assert out.columns == df.columns
    n = out.where("doc_id < 300").groupBy((F.col("doc_id") % 2).alias("b")).count().toPandas().set_index("b")["count"]
    assert 2.2 < n[0] / n[1] < 4.0
    none = M.memberships(df, named.limit(0), ["a", "b"]).toPandas()
    assert np.allclose(none.p0, 0.5)


def test_mixing_query_totals(spark):
    rows = QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    assert len(rows) == 1000
    for d, share in q_mixing.TARGETS.items():
        assert (rows.tokens * rows.rate * rows[f"p_{d}"]).sum() / rows.tokens.sum() == pytest.approx(share, abs=2e-3)
    assert rows.n_copies.between(np.floor(rows.rate), np.floor(rows.rate) + 1).all()


# ------------------------------------------------------------------ urls

def test_hosts_shrink_to_their_domain(spark):
    hosts = [("a.good.org", "good.org", "org", 200.0, 195.0), ("b.good.org", "good.org", "org", 0.0, 0.0), ("c.good.org", "good.org", "org", 1.0, 0.0),
             ("a.bad.org", "bad.org", "org", 200.0, 4.0), ("b.bad.org", "bad.org", "org", 1.0, 1.0), ("d.net", "d.net", "net", 0.0, 0.0)]
    df = spark.createDataFrame(hosts, "host string, domain string, suffix string, n double, y double")
    mean = {r["host"]: r["mean"] for r in U.reputation(df).collect()}
    assert mean["a.good.org"] > 0.9 > mean["c.good.org"] > mean["a.bad.org"]
    assert mean["b.good.org"] > mean["b.bad.org"]            # no labels: what the domain shows
    assert mean["c.good.org"] > 0.5                          # one bad page does not condemn
    pages = spark.createDataFrame([(k, f"http://{h}/p") for k, (h, *_) in enumerate(hosts)], "page_id long, url string")
    marks = spark.createDataFrame([(k, int(j < y)) for k, (_, _, _, n, y) in enumerate(hosts) for j in range(int(n))], "page_id long, good int")
    verdict = {r["host"]: r["verdict"] for r in U.judge(pages, marks, rules=()).collect()}
    assert verdict == {h[0]: "block" if h[0] == "a.bad.org" else "allow" for h in hosts} | {"b.bad.org": verdict["b.bad.org"]}


# -------------------------------------------------------------- sharding

def test_table_is_even_and_moves_little():
    shards = tuple(f"n{k}" for k in range(20))
    table = H.lookup_table(shards, 2003)
    counts = np.bincount(table)
    assert len(table) == 2003 and counts.max() - counts.min() <= 1
    less = H.lookup_table(shards[:-1], 2003)
    moved = sum(a != b for a, b in zip(table, less) if a != 19)
    assert moved < 0.2 * 2003
    for bad in ((), ("a", "a")):
        with pytest.raises(ValueError):
            H.lookup_table(bad, 7)
    with pytest.raises(ValueError):
        H.lookup_table(("a", "b"), 10)


def test_placement_keeps_columns_and_writes_all_rows(spark, tmp_path):
    docs = spark.createDataFrame([(k if k % 7 else None, "old", k) for k in range(200)], "doc_id long, shard string, slot int")
    placed = H.assign(docs.withColumn("text", F.lit("t")))
    assert placed.count() == 200 and set(placed.columns) == {"doc_id", "text", "slot", "shard"}
    assert placed.where("doc_id IS NULL").select("shard").distinct().count() == 1
    H.write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200
