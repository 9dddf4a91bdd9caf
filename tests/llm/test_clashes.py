"""Extra columns with any name the operators use themselves come back unchanged."""

import time

import pytest
from pyspark.sql import functions as F

import helpers
import corpus_pipeline as P
from eventide.llm import decontam, langid, licenses as S, linededup, mixing, sharding, simhash
from eventide.llm._text import fresh
from eventide.llm.q_langid import learned
from eventide.llm.q_mixing import TARGETS, domains

NAMES = ["__guess", "__letter", "__lang", "__score", "__kept_id", "__kept_hash", "__kept_n", "__id", "__hash", "__of", "__n", "__copy",
         "__slot", "__shard", "__drop", "__row", "__salt", "fp", "root", "component_id", "text_hash", "words", "h", "at", "copies",
         "rate", "tokens", "lang_", "score_", "__LANG_", "a.b"]


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    rows = [r for r in helpers.docs_rows() if r[1] is None or len(r[1]) < 1000]
    folder = helpers.write(tmp_path_factory.mktemp("c"), documents=rows, benchmark=[(1, helpers.ITEM)],
                           labels=[(k, k % 2, 0) for k in range(12)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return folder, docs, docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


def rows(df, columns):
    return sorted(str(tuple(r)) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect())


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, given, stage):
    folder, plain, extra = given
    fn = P.STAGES[stage][1]
    got = fn(spark, extra, folder)
    assert got.columns[:len(extra.columns)] == extra.columns
    assert rows(got, plain.columns) == rows(fn(spark, plain, folder), plain.columns)
    for r in got.collect():
        assert all(r[n] == (None if r["doc_id"] is None else f"{n} {r['doc_id']}") for n in NAMES)


PUBLIC = {
    "identify": lambda d, f: langid.identify(d, learned(d)),
    "dedup": lambda d, f: simhash.dedup(d),
    "remove_contaminated": lambda d, f: decontam.remove_contaminated(d, d.sparkSession.read.parquet(f"{f}/benchmark.parquet")),
    "mix": lambda d, f: mixing.mix(d, domains(d.sparkSession.read.parquet(f"{f}/labels.parquet")), TARGETS),
    "assign": lambda d, f: sharding.assign(d),
    "clean": lambda d, f: linededup.clean(d),
}


@pytest.mark.parametrize("name", sorted(PUBLIC))
def test_public_functions(given, name):
    folder, plain, extra = given
    got, want = PUBLIC[name](extra, folder), PUBLIC[name](plain, folder)
    assert rows(got, want.columns) == rows(want, want.columns)
    for r in got.collect():
        assert all(r[n] == (None if r["doc_id"] is None else f"{n} {r['doc_id']}") for n in NAMES)


def test_reports_ignore_further_columns(given):
    folder, plain, extra = given
    for fn in (lambda d: S.report(*S.scan(d)), lambda d: simhash.near_duplicates(d).drop("root")):
        assert sorted(map(str, fn(plain).collect())) == sorted(map(str, fn(extra).collect()))


def test_fresh_names():
    assert fresh(["A", "b_", "c"], "a", "a", "b", "C") == ["a_", "a__", "b", "C_"]


def test_licence_scan_is_linear_in_a_text(spark):
    def took(n):
        text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), i.cast("string"))),
                           F.lit("under the MIT license"))
        docs = spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text")).cache()
        docs.count()
        start = time.perf_counter()
        found = S.report(*S.scan(docs)).collect()
        took = time.perf_counter() - start
        assert [(r["n_words"], r["first_word"], r["labels"]) for r in found] == [(n + 4, n, "mit")]
        return took
    took(1000)
    assert took(320_000) < 10 * took(40_000)
