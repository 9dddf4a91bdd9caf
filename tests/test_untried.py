"""Small public functions that no query runs: collections, batch writers, ingestion time,
pandas flatMap, parallelism, the streamed running minimum, processing-time windows."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from eventide.functions.udf import flat_map_pandas
from eventide.operators import keys as K
from eventide.operators import rolling as R
from eventide.operators import windows as W
from eventide.operators.timecols import with_ingestion_time, with_processing_time
from eventide.plans.common import events
from eventide.sinks.basic import write_rows
from eventide.sources.collection import from_collection
from eventide.streaming import processors as P
from eventide.streaming.runner import run_until_done, start
from eventide.streaming.sources import readings_stream
from replay import stage_replay


def _fresh():
    return tempfile.mkdtemp(prefix="evt-untried-", dir="/tmp")


def _readings(spark):
    return events(spark, SF001).select(F.col("id").cast("string").alias("id"), "ts", "temperature", "seq")


def _stage(readings, files=4):
    folder = os.path.join(_fresh(), "in")
    stage_replay(readings, folder, files, ["ts", "seq"])
    return folder


def _run(df, name, mode="append"):
    q = start(df, "memory", name=name, mode=mode, checkpoint=os.path.join(_fresh(), "ck"), trigger={"availableNow": True})
    run_until_done(q, 240)
    return df.sparkSession.table(name)


def test_collection_keeps_rows_and_types(spark):
    got = from_collection(spark, (("a", n) for n in range(3)), "k string, n long")
    assert got.dtypes == [("k", "string"), ("n", "bigint")]
    assert sorted(map(tuple, got.collect())) == [("a", 0), ("a", 1), ("a", 2)]
    assert from_collection(spark, [], "k string").collect() == []


def test_write_rows_formats_and_modes(spark):
    rows = spark.range(5).select("id", F.concat(F.lit("n;"), F.col("id")).alias("name"))
    folder = _fresh()
    for fmt, options in (("csv", {"sep": ";", "header": "true"}), ("json", None), ("parquet", None)):
        path = f"{folder}/{fmt}"
        write_rows(rows, path, fmt, options=options)
        write_rows(rows, path, fmt, options=options)
        back = spark.read.format(fmt).options(**(options or {})).schema("id long, name string").load(path)
        assert sorted(map(tuple, back.collect())) == sorted(2 * [tuple(r) for r in rows.collect()])
    write_rows(rows.limit(1), f"{folder}/json", "json", mode="overwrite")
    assert spark.read.json(f"{folder}/json").count() == 1


def test_ingestion_time_is_event_time_of_the_rows(spark):
    before = dt.datetime.now()
    stamped = with_ingestion_time(_readings(spark).drop("ts"))
    counted = W.window_agg(stamped, "id", "ts", "365 days", [F.count(F.lit(1)).alias("n")]).collect()
    lo, hi = stamped.agg(F.min("ts"), F.max("ts")).first()
    assert lo == hi and abs((lo - before).total_seconds()) < 120
    assert sum(r["n"] for r in counted) == stamped.count()


def test_flat_map_pandas_gives_no_or_many_rows(spark):
    def twice_if_even(batch):
        even = batch[batch["id"] % 2 == 0]
        return even.loc[even.index.repeat(2)]

    got = flat_map_pandas(spark.range(7), "id long", twice_if_even)
    assert sorted(r["id"] for r in got.collect()) == [0, 0, 2, 2, 4, 4, 6, 6]
    assert flat_map_pandas(spark.range(0), "id long", twice_if_even).collect() == []


def test_parallelism_keeps_rows(spark):
    many = K.with_parallelism(spark.range(100), 5)
    assert many.rdd.getNumPartitions() == 5 and many.count() == 100
    keyed = K.by_key(spark.range(100).withColumn("k", F.col("id") % 7), 4, "k")
    places = keyed.select("k", F.spark_partition_id().alias("p")).distinct()
    assert places.count() == 7 and keyed.rdd.getNumPartitions() == 4


def test_running_minimum_stream_equals_batch(spark):
    readings = _readings(spark)
    stream = readings_stream(spark, _stage(readings), readings.schema).withWatermark("ts", "0 seconds")
    got = _run(P.apply(stream, P.RollingMin()), "rolling_min_stream").select("seq", "temperature").collect()
    want = R.rolling_min(readings, "id", current=("ts", "seq")).select("seq", "temperature").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_processing_time_sliding_and_session_windows(spark):
    readings = _readings(spark)
    stream = with_processing_time(readings_stream(spark, _stage(readings, 2), readings.schema)).withWatermark("proc_ts", "0 seconds")
    n = F.count(F.lit(1)).alias("n")
    sliding = _run(W.window_agg(stream, "id", "proc_ts", "2 days", [n], slide="1 day"), "proc_sliding", "complete")
    per_key = {r["id"]: r["n"] for r in sliding.groupBy("id").agg(F.sum("n").alias("n")).collect()}
    counts = {r["id"]: r["count"] for r in readings.groupBy("id").count().collect()}
    assert per_key == {k: 2 * c for k, c in counts.items()}       # every row is in size / slide windows
    sessions = _run(W.session_window_stream(stream, "id", "proc_ts", "1 day", [n]), "proc_session", "complete")
    # the files follow within seconds, so a key has one session
    assert {r["id"]: r["n"] for r in sessions.collect()} == counts
    assert sessions.count() == len(counts)
