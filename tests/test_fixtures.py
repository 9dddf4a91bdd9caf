"""Hand-worked expectations on the reference's sample inputs."""

from pyspark.sql import functions as F

from conftest import WORD_LINES
from eventide.operators import alerts as A
from eventide.operators import rolling as R
from eventide.operators import transform as T
from eventide.operators import windows as W
from eventide.operators.wordcount import word_count


def test_parse(sensors):
    rows = sensors.orderBy("seq").collect()
    assert len(rows) == 12
    assert rows[0]["id"] == "sensor_1" and rows[0]["temperature"] == 35.8
    assert str(rows[0]["ts"]) == "2019-01-17 09:43:19"


def test_word_count(spark):
    lines = spark.createDataFrame([(x,) for x in WORD_LINES], "line string")
    got = {r["word"]: r["cnt"] for r in word_count(lines).collect()}
    assert got == {"hello": 3, "you": 3, "are": 1, "and": 1, "fine": 1, "flink": 1, "how": 1,
                   "scala": 1, "thank": 1, "world": 1}


def test_java_split_semantics(spark):
    from eventide.functions.scalar import java_split
    df = spark.createDataFrame([("a  b ",), ("",), ("   ",), (" a",)], "s string")
    got = [r[0] for r in df.select(java_split("s", " ")).collect()]
    assert got == [["a", "", "b"], [""], [], ["", "a"]]


def test_rolling_sum_tuples(spark):
    df = spark.createDataFrame([(1, 2, 2, 0), (2, 3, 1, 1), (2, 2, 4, 2), (1, 5, 3, 3)],
                               "_1 int, _2 int, _3 int, seq long")
    df = df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    out = R.rolling_sum(df, "_1", "_2", chunk="1 day").orderBy("seq")
    assert [r["_2"] for r in out.collect()] == [2, 3, 5, 7]


def test_list_reduce(spark):
    df = spark.createDataFrame([("en", ["tea"], 0), ("fr", ["vin"], 1), ("en", ["cake"], 2)],
                               "_1 string, _2 array<string>, seq long")
    df = df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    out = R.rolling_concat(df, "_1", "_2").orderBy("seq").collect()
    assert [r["_2"] for r in out] == [["tea"], ["vin"], ["tea", "cake"]]


def test_running_min(sensors):
    out = R.rolling_min(sensors.where(F.col("id") == "sensor_1"), "id", chunk="5 seconds")
    # every output row carries the first reading's ts/seq, so compare values
    got = sorted((r["temperature"] for r in out.collect()), reverse=True)
    assert got == [35.8, 32.0, 32.0, 29.7, 29.7, 29.7, 29.7, 29.7, 29.7]
    firsts = {(r["ts"], r["seq"]) for r in out.collect()}
    assert len(firsts) == 1  # other fields keep the first reading


def test_rolling_reduce(sensors):
    out = R.rolling_reduce_min_latest(sensors, "id", chunk="7 seconds")
    last = out.where(F.col("id") == "sensor_1").orderBy(F.desc("seq")).first()
    assert last["temperature"] == 29.7 and str(last["ts"]) == "2019-01-17 09:45:19"


def test_jump_alert(sensors):
    assert A.jump_alert(sensors, "id", 10.0, chunk="3 seconds").count() == 0
    rows = A.jump_alert(sensors, "id", 5.0, chunk="3 seconds").collect()
    assert [(r["id"], r["prev_temp"], r["temperature"]) for r in rows] == [("sensor_1", 36.2, 29.7)]


def test_split(sensors):
    routed = T.route(sensors, {"high": F.col("temperature") > 30, "low": F.col("temperature") <= 30})
    assert T.select_outputs(routed, ["high"]).count() == 9
    low = T.select_outputs(routed, ["low"]).collect()
    assert sorted((r["id"], r["temperature"]) for r in low) == [
        ("sensor_1", 29.7), ("sensor_6", 15.4), ("sensor_7", 6.7)]
    both = T.select_outputs(routed, ["low", "high"])
    assert both.count() == 12


def test_sessions(sensors):
    for chunk in ("4 seconds", "1 day"):
        out = W.sessions(sensors.where(F.col("id") == "sensor_1"), "id", "ts", "10 seconds",
                         [F.count(F.lit(1)).alias("n")], chunk=chunk).orderBy("window_start").collect()
        assert [(str(r["window_start"]), str(r["window_end"]), r["n"]) for r in out] == [
            ("2019-01-17 09:43:19", "2019-01-17 09:43:49", 8),
            ("2019-01-17 09:45:19", "2019-01-17 09:45:29", 1)]


def test_count_windows(sensors):
    s1 = sensors.where(F.col("id") == "sensor_1")
    tumbling = W.count_windows(s1, "id", 3, [F.min("temperature").alias("m")], chunk="4 seconds")
    assert sorted((r["window_seq"], r["m"]) for r in tumbling.collect()) == [(3, 32.0), (6, 29.7), (9, 30.9)]
    sliding = W.count_windows(s1, "id", 3, [F.count(F.lit(1)).alias("n")], slide=2, chunk="4 seconds")
    assert sorted((r["window_seq"], r["n"]) for r in sliding.collect()) == [(2, 2), (4, 3), (6, 3), (8, 3)]
