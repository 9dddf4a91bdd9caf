import hashlib
import random
import re

import pytest

import helpers
from eventide.llm import decontam as D
from eventide.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, size=10):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            v = words(text)
            for k in range(max(1, len(v) - size + 1)) if v else []:
                win = v[k:k + size]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        ids.add(str(item))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


ITEMS = [(1, helpers.ITEM), (2, "one two"), (10, "two three"), (3, None), (4, "?!"), (5, helpers.ITEM), (None, "text of the")]


def test_query_on_awkward_rows(spark, tmp_path):
    rows, items = helpers.docs_rows(), ITEMS[:-1]
    got = QUERIES["op2_decontamination"](spark, helpers.write(tmp_path, documents=rows, benchmark=items)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute([r[:2] for r in rows], items), key=key)


def test_sql_on_sf(spark):
    assert helpers.same_as_sql(spark, "/root/testdata/sf0.001", "op2_decontamination") == 200


@pytest.mark.parametrize("segment_words, block_words", [(1 << 20, 1 << 20), (100, 60)])
def test_small_segments_and_blocks_give_the_same(spark, segment_words, block_words):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    docs, items = [(k, text(rng.randrange(120))) for k in range(40)], [(k, text(rng.randrange(1, 9))) for k in range(12)]
    index = D.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), segment_words=segment_words)
    if segment_words == 100:
        assert index.where("kind = 'doc'").select("segment").distinct().count() > 5
    found = D.report(index, D.search(index, spark.createDataFrame(items, "item_id long, text string"), size=4, block_words=block_words))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    want = [(i, n, h, c) for i, n, h, c, _, _ in brute(docs, items, 4)]
    assert sorted((a, b, c, len(d)) for a, b, c, d in got) == sorted(want)


def test_near_matches_equal_brute_force(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(rng.choice("abcdef") for _ in range(60))) for k in range(8)]
    item, slop = "a b c d", 1
    index = D.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = D.search(index, spark.createDataFrame([(1, item)], "item_id long, text string"), size=4, slop=slop)
    ids = {(r["segment"], r["doc_ord"]): r["doc_id"] for r in index.where("kind = 'doc'").collect()}
    got = {}
    for r in rows.where("kind = 'near'").collect():
        got.setdefault(ids[r["segment"], r["doc_ord"]], set()).update(range(r["start"], r["end"]))
    for i, t in docs:
        w, v, want = words(t), words(item), set()
        for p in range(len(w)):
            if w[p] == v[0] and all(any(0 <= p + j + e < len(w) and w[p + j + e] == x for e in range(-slop, slop + 1))
                                    for j, x in enumerate(v) if j):
                want |= set(range(p, p + len(v)))
        assert got.get(i, set()) == want
    with pytest.raises(ValueError):
        D.search(index, spark.createDataFrame([(1, item)], "item_id long, text string"), size=60, slop=10)


def test_remove_contaminated_and_empty_tables(spark, tmp_path):
    rows = helpers.docs_rows()
    folder = helpers.write(tmp_path, documents=rows, benchmark=[(1, helpers.ITEM)])
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    left = D.remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    want = [r[0] for r, b in zip(rows, brute([r[:2] for r in rows], [(1, helpers.ITEM)])) if not b[5]]
    assert sorted((r["doc_id"] for r in left.collect()), key=lambda x: (x is None, x)) == sorted(want, key=lambda x: (x is None, x))
    assert D.remove_contaminated(docs, bench.limit(0)).count() == len(rows)
    (tmp_path / "e").mkdir()
    assert QUERIES["op2_decontamination"](spark, helpers.write(tmp_path / "e")).count() == 0
