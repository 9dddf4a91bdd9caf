"""Outputs that become visible together; documents replaced by id."""

import os

import pytest
from pyspark.sql import functions as F

from eventide.operators import panes as B
from eventide.sinks.basic import document_frame
from eventide.sinks.manifest import DocumentStore, ManifestSink
from eventide.streaming.runner import run_until_done, start
from eventide.streaming.sources import readings_stream
from test_streaming import _fresh, _readings, _stage


def _outputs():
    return {"hot": lambda b: b.where("temperature > 50"), "counts": lambda b: b.groupBy("id").count()}


def _batch(spark, lo, hi):
    return _readings(spark).where(f"seq >= {lo} AND seq < {hi}")


def test_killed_between_outputs_shows_neither(spark):
    root = _fresh() + "/m"
    sink = ManifestSink(root, _outputs())
    sink(_batch(spark, 0, 300), 0)
    seen = sink.read(spark, "hot").count(), sink.read(spark, "counts").agg(F.sum("count")).first()[0]
    assert seen[1] == 300

    def killed(_):
        raise RuntimeError("killed")

    broken = ManifestSink(root, {"hot": _outputs()["hot"], "counts": killed})
    with pytest.raises(RuntimeError):
        broken(_batch(spark, 300, 700), 1)
    assert len(os.listdir(root + "/hot")) == 2          # its files are there, and nobody reads them
    assert (sink.read(spark, "hot").count(), sink.read(spark, "counts").agg(F.sum("count")).first()[0]) == seen
    for _ in range(2):                                  # the replay commits once
        sink(_batch(spark, 300, 700), 1)
        assert sink.read(spark, "counts").agg(F.sum("count")).first()[0] == 700
        assert sink.read(spark, "hot").count() == _batch(spark, 0, 700).where("temperature > 50").count()
    assert sink.remove_uncommitted(spark) == 1 and sink.remove_uncommitted(spark) == 0
    assert sink.read(spark, "counts").agg(F.sum("count")).first()[0] == 700


def test_records_are_compacted(spark):
    root = _fresh() + "/m"
    sink = ManifestSink(root, {"rows": lambda b: b}, compact=3)
    for k in range(8):
        sink(spark.range(k * 10, k * 10 + 10), k)
        assert sink.read(spark, "rows").count() == 10 * (k + 1) and len(sink.log.ids(spark)) <= 3
    sink(spark.range(5), 4)                             # an old batch is not written again
    assert sink.read(spark, "rows").count() == 80


def test_stream_into_a_manifest_survives_a_restart(spark):
    r = _readings(spark)
    folder, root = _stage(spark, r, 4), _fresh()
    sink = ManifestSink(root + "/m", _outputs())
    for _ in range(2):
        run_until_done(start(readings_stream(spark, folder, r.schema), sink, checkpoint=root + "/ck", trigger={"availableNow": True}), 240)
        assert sink.read(spark, "counts").agg(F.sum("count")).first()[0] == r.count()


def test_documents_are_replaced_by_id(spark):
    root = _fresh() + "/d"
    store = DocumentStore(root, buckets=8)
    r = _readings(spark)

    def docs(rows, label):
        return document_frame(rows.withColumn("label", F.lit(label)), ["id", "temperature", "label"], ["seq"], "readings")

    def labels():
        return {x["label"]: x["count"] for x in store.read(spark).groupBy(F.get_json_object("doc", "$.label").alias("label")).count().collect()}

    assert store.read(spark) is None
    store(docs(r.where("seq < 600"), "a"), 0)
    store(docs(r.where("seq < 1"), "b"), 1)             # one document, one bucket
    newest = store._newest(spark)
    assert len(newest) == 8 and sum("batch_id=1-" in f for f in newest.values()) == 1
    assert labels() == {"a": 599, "b": 1}
    for _ in range(2):                                  # a replay leaves one document an id
        store(docs(r.where("seq >= 500"), "c").unionByName(docs(r.where("seq >= 500"), "c")), 2)
        assert labels() == {"a": 499, "b": 1, "c": 500}
        assert store.read(spark).groupBy("index", "doc_id").count().where("count > 1").count() == 0
    store(docs(r.where("false"), "d"), 3)               # an empty batch
    assert labels() == {"a": 499, "b": 1, "c": 500}
    assert store.remove_replaced(spark) > 0 and labels() == {"a": 499, "b": 1, "c": 500}


def test_time_evictor_is_one_pass(spark):
    from eventide.plans.catalog import spark_queries
    from conftest import SF01
    plan = spark_queries()["evict_time"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    rows = _readings(spark)
    for chunk in (None, "10 days"):
        got = B.evict_older_than(rows, ["id"], "ts", "7 days", chunk=chunk)
        newest = rows.groupBy("id").agg(F.max("ts").alias("newest"))
        want = rows.join(newest, "id").where("ts >= newest - INTERVAL 7 DAYS").drop("newest")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
