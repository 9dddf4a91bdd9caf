"""A control input for all keys as broadcast change points; checked broadcasts."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from eventide.operators import combine as C, keys as K
from eventide.plans.catalog import spark_queries
from eventide.plans.common import events


def _sides(spark, nulls=True):
    r = events(spark, SF01, keep=("event_type",))
    if nulls:
        r = r.withColumn("ts", F.when(F.col("seq") % 97 != 0, F.col("ts")))
    # whole hours: many rows of one time on both sides
    r = r.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    control = r.where("event_type = 'view'").select("ts", "seq", F.when(F.col("temperature") > 60, "High").when(
        F.col("temperature") > 20, "Low").alias("level"), (F.col("id") % 2).alias("zone"))
    return r.where("event_type <> 'view'"), control


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("nulls", [True, False])
def test_change_points_equal_the_scan(spark, nulls):
    data, control = _sides(spark, nulls)
    got = C.asof_broadcast(data, control, "ts", "seq", ["level", "zone"])
    _same(got, C.asof_lookup(data, control, None, "ts", "seq", ["level", "zone"]))
    assert got.where("level IS NULL").count() > 0 and got.count() == data.count()


def test_beyond_the_bound_and_without_control(spark):
    data, control = _sides(spark)
    want = C.asof_lookup(data, control, None, "ts", "seq", ["level"])
    _same(C.asof_broadcast(data, control, "ts", "seq", ["level"], most_bytes=10), want)
    none = C.asof_broadcast(data, control.where("false"), "ts", "seq", ["level"])
    assert none.count() == data.count() and none.where("level IS NOT NULL").count() == 0
    early = control.where("ts IS NULL")
    _same(C.asof_broadcast(data, early, "ts", "seq", ["level"]), C.asof_lookup(data, early, None, "ts", "seq", ["level"]))


def test_only_changes_are_points(spark):
    _, control = _sides(spark)
    points = C.change_points(control, "ts", "seq", ["level"])
    assert 1 < points.count() < control.groupBy("ts").count().count()
    rows = points.orderBy("t").collect()
    assert all(a["v"] != b["v"] for a, b in zip(rows, rows[1:])) and rows[0]["t"] == C.NO_TIME


def test_readings_are_not_shuffled(spark):
    plan = spark_queries()["fire_alert"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    readings, levels = plan.split("BroadcastExchange", 1)
    assert "Exchange" not in readings.replace("BroadcastExchange", "") and "BroadcastHashJoin" in readings
    # what the readings' side reads, below the broadcast one
    assert plan.rstrip().splitlines()[0].startswith("AdaptiveSparkPlan") and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_broadcast_is_checked(spark):
    big, small = spark.range(5000).withColumn("v", F.repeat(F.lit("x"), 50)), spark.range(10)
    assert K.measured_bytes(big) > 5000 * 50 and K.measured_bytes(spark.range(0)) == 0
    def hinted(df):
        return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(K.broadcast_small(small)) and not hinted(K.broadcast_small(big, 1000))
    assert spark.range(20).join(K.broadcast_small(small), "id").count() == 10
