"""One key holding a third of all rows: the scan cuts it at row quantiles
into bounded (key, chunk) groups and still equals the single-pass result,
whatever the target, with bursts, outliers and NULLs."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from eventide.operators import panes as P, windows as W
from eventide.operators.scan import CHUNK_CONF, TARGET_ROWS_CONF, Scan, resolve_chunking, scan
from eventide.plans.common import events


@pytest.fixture
def target(spark):
    yield lambda n: spark.conf.set(TARGET_ROWS_CONF, str(n))
    spark.conf.unset(TARGET_ROWS_CONF)


def _skewed(spark):
    r = events(spark, SF01)
    return r.withColumn("id", F.when(F.pmod("seq", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("id")))


def _equal(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_key_is_split_and_exact(spark, target):
    target(300)
    r = _skewed(spark)
    hot = r.where("id = 0").count()
    assert hot * 3 >= r.count() - 3
    plan = resolve_chunking(r, ["id"], "ts")
    assert plan.hot is not None and plan.hot.count() == 1  # only the hot key is cut finer
    chunks = plan.apply(r, "ts").groupBy("id", "__chunk").count()
    hot_g = chunks.where("id = 0").agg(F.count("*").alias("n"), F.max("count").alias("mx")).first()
    assert hot_g["n"] >= 8 and hot_g["mx"] <= 2 * 300
    # every other key stays one chunk: the carry table is ~one row per key
    assert chunks.where("id != 0").groupBy("id").count().where("count > 1").count() == 0
    got = scan(r, ["id"], "ts", ["seq"], [Scan("s", "sum", "temperature"), Scan("p", "prev", "temperature")])
    w = Window.partitionBy("id").orderBy("ts", "seq")
    want = r.select("*", F.sum("temperature").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.lag("temperature").over(w).alias("p"))
    _equal(*(d.withColumn("s", F.round("s", 6)) for d in (got, want)))


def _burst(spark):
    """600 rows of one key within a second, one 75 years later, some before."""
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = spark.range(700).select(
        F.lit("k").alias("id"), F.col("id").alias("seq"), F.col("id").cast("double").alias("temperature"),
        F.when(F.col("id") == 699, F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"))
        .when(F.col("id") >= 99, F.timestamp_add("MICROSECOND", F.col("id") * 1000, base))
        .otherwise(F.timestamp_add("HOUR", F.col("id") - 200, base)).alias("ts"))
    return rows


@pytest.mark.parametrize("keys", [["id"], []])
def test_bursts_and_outliers_leave_chunks_even(spark, target, keys):
    target(100)
    r = _burst(spark)
    sizes = [x["count"] for x in resolve_chunking(r, keys, "ts").apply(r, "ts").groupBy("__chunk").count().collect()]
    assert sum(sizes) == 700 and max(sizes) < 200 and len(sizes) >= 5


def test_keyless_scan_never_puts_all_rows_in_one_task(spark):
    r = events(spark, SF01)
    out = scan(r, [], "ts", ["seq"], [Scan("n", "count", F.lit(1))])
    chunks = scan(r, [], "ts", ["seq"], [Scan("n", "count", F.lit(1))], keep_chunk=True).groupBy("__chunk").count()
    assert chunks.count() >= 8 and chunks.agg(F.max("count")).first()[0] < 2 * r.count() / 8
    assert out.agg(F.max("n"), F.countDistinct("n")).first() == (10000, 10000)


def _with_nulls(spark):
    return events(spark, SF01).where("seq < 2000").select(
        F.when(F.pmod("seq", F.lit(10)) == 0, None).when(F.pmod("seq", F.lit(3)) == 0, 0).otherwise(F.col("id") % 5).alias("id"),
        F.when(F.pmod("seq", F.lit(17)) != 0, F.col("ts")).alias("ts"), "temperature", "seq")


def _specs():
    return [Scan("a", "sum", "seq"), Scan("b", "count", "temperature"), Scan("c", "min", "temperature"), Scan("d", "max", "temperature"),
            Scan("e", "max_excl", "temperature"), Scan("f", "first", "seq"), Scan("g", "last_nonnull", F.when(F.col("seq") % 4 == 0, F.col("seq"))),
            Scan("h", "prev", "seq")]


@pytest.mark.parametrize("keys", [["id"], []])
def test_nulls_give_the_same_at_every_size(spark, target, keys):
    r = _with_nulls(spark)
    whole = scan(r, keys, "ts", ["seq"], _specs(), chunk="36500 days")
    for n in (4_000_000, 100):
        target(n)
        _equal(scan(r, keys, "ts", ["seq"], _specs()), whole)
    _equal(scan(r, keys, "ts", ["seq"], _specs(), chunk="2 hours"), whole)


def test_sessions_keep_null_keys_and_times(spark, target):
    r = _with_nulls(spark)
    aggs = [F.count(F.lit(1)).alias("n"), F.max("temperature").alias("mx")]
    whole = W.sessions(r, "id", "ts", "30 minutes", aggs, chunk="36500 days")
    assert whole.agg(F.sum("n")).first()[0] == r.count()
    for n in (4_000_000, 100):
        target(n)
        _equal(W.sessions(r, "id", "ts", "30 minutes", aggs), whole)
    _equal(W.sessions(r, "id", "ts", "30 minutes", aggs, chunk="2 hours"), whole)


def test_time_evictor_keeps_null_keys(spark):
    r = _with_nulls(spark).where("ts IS NOT NULL")
    assert P.evict_older_than(r, ["id"], "ts", "3650 days").count() == r.count()


def test_large_cut_tables_are_joined_by_shuffle(spark, target, monkeypatch):
    from eventide.operators import scan as S
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    target(100)
    r = _with_nulls(spark)
    assert not resolve_chunking(r, ["id"], "ts").small
    _equal(scan(r, ["id"], "ts", ["seq"], _specs()), scan(r, ["id"], "ts", ["seq"], _specs(), chunk="36500 days"))


def test_grown_input_is_probed_again(spark, target, tmp_path):
    target(100)
    r = _burst(spark)
    r.limit(30).write.parquet(str(tmp_path / "t"))
    assert resolve_chunking(spark.read.parquet(str(tmp_path / "t")), ["id"], "ts").single
    r.write.mode("append").parquet(str(tmp_path / "t"))
    assert not resolve_chunking(spark.read.parquet(str(tmp_path / "t")), ["id"], "ts").single


def test_conf_names_are_sparks(spark):
    assert CHUNK_CONF.startswith("spark.") and TARGET_ROWS_CONF.startswith("spark.")
