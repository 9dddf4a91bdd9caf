import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import helpers
from eventide.llm import simhash as S
from eventide.llm.components import connected_components
from eventide.llm.queries import QUERIES


def brute_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=2):
    """[(id, fingerprint)] -> least id reachable, per row."""
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= radius and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    least = {c: min((r[0] for r, d in zip(rows, comp) if d == c and r[0] is not None), default=None) for c in set(comp)}
    return [least[c] for c in comp]


def test_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b ç")).alias("h")).first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest("a b ç".encode(), 42)


def test_query_on_awkward_rows(spark, tmp_path):
    rows = helpers.docs_rows()
    got = QUERIES["op4_simhash"](spark, helpers.write(tmp_path, documents=rows)).collect()
    marks = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = [(i, f"{fp:016x}", c) for (i, fp), c in zip(marks, brute_components(marks))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_query_on_sf_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op4_simhash"](spark, "/root/testdata/sf0.001").collect()}
    marks = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs]
    assert got == {i: (f"{fp:016x}", c) for (i, fp), c in zip(marks, brute_components(marks))}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_reach_what_brute_force_reaches(spark, radius):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for fp in list(fps):
        for _ in range(4):      # chains of close fingerprints
            for b in rng.sample(range(64), rng.randint(1, radius + 1)):
                fp ^= 1 << b
            fps.add(fp)
    rows = [(k, fp) for k, fp in enumerate(sorted(fps))]
    df = spark.createDataFrame([(k, fp - (1 << 64) if fp >> 63 else fp) for k, fp in rows], "id long, fp long")
    pairs = S.links(df.select("fp"), radius)
    assert all(bin((r["a"] ^ r["b"]) % (1 << 64)).count("1") <= radius for r in pairs.collect())
    root = {r["node"]: r["root"] for r in connected_components(pairs).collect()}
    want = brute_components(rows, radius)
    groups = {}
    for (k, fp), c in zip(rows, want):
        signed = fp - (1 << 64) if fp >> 63 else fp
        groups.setdefault(c, set()).add(root.get(signed, signed))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_dedup_keeps_one_row_a_component_with_all_columns(spark, tmp_path):
    docs = spark.read.parquet(helpers.write(tmp_path, documents=helpers.docs_rows()) + "/documents.parquet")
    docs = docs.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("mine"))
    found = S.near_duplicates(docs)
    kept = S.dedup(docs)
    assert kept.columns == docs.columns
    assert kept.count() == found.select("root").distinct().count()
    least = {r["c"] for r in found.groupBy("root").agg(F.min("component_id").alias("c")).collect()}
    assert {r["doc_id"] for r in kept.collect()} == least


def test_empty_table(spark, tmp_path):
    folder = helpers.write(tmp_path)
    assert QUERIES["op4_simhash"](spark, folder).count() == 0
    assert S.dedup(spark.read.parquet(folder + "/documents.parquet")).count() == 0


@pytest.mark.parametrize("edges", [
    [], [(1, 1), (None, 2)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 40)],
    [(random.Random(k).randrange(80), random.Random(-k).randrange(80)) for k in range(70)]])
def test_components_equal_union_find(spark, edges):
    df = spark.createDataFrame(edges, "a int, b int")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            up[find(a)] = find(b)
    assert set(got) == set(up)
    assert all((got[a] == got[b]) == (find(a) == find(b)) for a in up for b in up)
