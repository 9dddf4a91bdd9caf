import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import helpers
from eventide.llm import langid as L, toxicity as T
from eventide.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(0)
    say = lambda ws: " ".join(rng.choice(ws, 40)).encode()
    return L.train([say(["the", "of", "and"]) for _ in range(60)] + [say(["der", "und", "nicht"]) for _ in range(60)],
                   ["en"] * 60 + ["de"] * 60)


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    got = QUERIES["op1_language_id"](spark, SF).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert all(h == (remainder(i, 3) == 1) for i, h in zip(got.doc_id, got.held_out))
    assert got.score.between(0, 1).all()
    held = got[got.held_out & got.lang.notna()]
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_language_cases(spark, net):
    rows = [(1, None, "x"), (2, "", "x"), (3, " 12 !? ", "x"), (4, "the of and the", "x"), (5, "UND DER NICHT", "x"),
            (4, "the of and the", "x"), (None, "der und nicht und der", "x"), (7, "the of " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = [tuple(r) for r in L.identify(docs, net).collect()]
    lang = {(r[0], r[1]): r[2] for r in got}
    assert len(got) == len(rows)
    assert [lang[r[0], r[1]] for r in rows] == ["und", "und", "und", "en", "de", "en", "de", "en"]
    assert all(r[3] == 0 for r in got if r[2] == "und")
    assert L.identify(docs.limit(0), net).count() == 0
    assert {r["lang_pred"] for r in L.identify(docs, None).collect()} == {"und"}


def test_whole_texts_count(net):
    """The language of the longer part wins, wherever it stands."""
    def best(text):
        rows, _, used = L.windows_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        return net.labels[int((net.posteriors(rows) * used[:, None]).sum(axis=0).argmax())]
    assert best(b"the and of " * 50 + b"und der nicht " * 400) == "de"
    assert best(b"the and of " * 400 + b"und der nicht " * 50) == "en"


def test_windows_cover_all_bytes():
    data = np.arange(1, 200, dtype=np.uint8).repeat(5)
    bounds = np.array([0, 0, 1, 600, len(data)])
    rows, of, used = L.windows_of(data, bounds)
    assert [b"".join(r[:u].tobytes() for r, u, o in zip(rows, used, of) if o == k) for k in range(4)] \
        == [data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
    assert all((r[u:] == 0).all() for r, u in zip(rows, used))


def test_learning_skips_held_out_and_unlabelled(spark):
    docs = spark.createDataFrame([(k, f"text {k}", None if k % 2 else "en") for k in range(30)] + [(None, "t", "fr")],
                                 "doc_id long, text string, lang string")
    texts, labels = L.training_rows(docs, rows=100)
    assert set(labels) == {"en"} and len(texts) == 15 * len(L.SAMPLE_CHARS)
    assert L.training_rows(docs.limit(0)) == ([], [])
    assert len(L.training_rows(docs, rows=5)[0]) <= 2 * 5 * len(L.SAMPLE_CHARS)


def test_toxic_held_out_rows(spark):
    got = QUERIES["op10_toxicity"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert all(h == (remainder(i, 4) == 2) for i, h in zip(got.doc_id, got.held_out))
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    seen = got.merge(labels, on="doc_id")
    seen = seen[seen.held_out]
    flagged = seen[seen.predicted == 1]
    assert len(flagged) and (flagged.toxic == 1).mean() > 0.8
    assert (seen[seen.toxic == 1].predicted == 1).mean() > 0.5


def hashed(texts):
    return [np.unique(T.term_hashes(pa.array([t]))[0]) for t in texts]


def test_machine_learns_an_interaction():
    """Label 1 only where both words stand together; neither alone is bad."""
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for _ in range(600):
        a, b = map(bool, rng.random(2) < 0.5)
        texts.append(" ".join(["fool"] * a + ["group"] * b + [f"w{rng.integers(30)}"]))
        labels.append(int(a and b))
    m = T.train(hashed(texts), np.array(labels), share=float(np.mean(labels)))
    both, one, other, none = m.score(pa.array(["fool group w1", "fool w1", "group w1", "w1"]))
    assert both > 0.8 and max(one, other, none) < 0.3
    linear = T.Machine(m.column, m.bias, m.weight, np.zeros_like(m.factor))
    z = np.log(1 / linear.score(pa.array(["fool group w1", "fool w1", "group w1", "w1"])) - 1)
    assert z[0] - z[1] - z[2] + z[3] == pytest.approx(0, abs=1e-9)     # additive weights have no interaction


def test_toxic_cases(spark):
    m = T.train(hashed(["bad x"] * 30 + ["good x"] * 60), np.array([1] * 30 + [0] * 60), share=1 / 3)
    rows = [(1, None), (2, ""), (3, "..."), (4, "BAD"), (4, "BAD"), (None, "good"), (6, "good " * 50_000 + "bad")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("old"))
    got = {(r["doc_id"], r["text"]): r["score"] for r in T.score(docs, m).collect()}
    assert T.score(docs, m).count() == len(rows)
    assert got[1, None] == got[2, ""] == got[3, "..."]
    assert got[4, "BAD"] > 0.5 > got[None, "good"]
    assert T.score(docs.limit(0), m).count() == 0
    only = T.train(hashed(["a b", "c"]), np.array([0, 0]), share=0.0)
    assert only.score(pa.array(["a"]))[0] < 1e-9
    assert T.train([], np.zeros(0, np.int64), 0.0).score(pa.array(["a", None])).max() < 1e-9


def test_queries_on_awkward_and_empty_tables(spark, tmp_path):
    rows = helpers.docs_rows()
    folder = helpers.write(tmp_path, documents=rows, labels=[(1, 1, 0), (2, 0, 1), (2, 0, 1), (3, None, None), (None, 1, 1), (99, 1, 1)])
    (tmp_path / "e").mkdir()
    empty = helpers.write(tmp_path / "e")
    for name in ("op1_language_id", "op10_toxicity"):
        assert QUERIES[name](spark, folder).count() == len(rows)
        assert QUERIES[name](spark, empty).count() == 0
