"""Order cuts inside equal times, ordered folds by pieces, back-fill by merged states."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from eventide.operators import late as L
from eventide.operators.accumulate import Accumulator, window_accumulate
from eventide.operators.fold import Fold, ordered_fold, window_fold
from eventide.operators.scan import TARGET_ROWS_CONF, Scan, resolve_chunking, scan
from eventide.plans.common import events


@pytest.fixture
def target(spark):
    yield lambda n: spark.conf.set(TARGET_ROWS_CONF, str(n))
    spark.conf.unset(TARGET_ROWS_CONF)


def _one_time(spark, rows=3000, keys=1):
    """2,500 of 3,000 rows at one time, the others later."""
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(rows).repartition(5).select(
        (F.col("id") % keys).alias("id"), F.col("id").alias("seq"), F.col("id").cast("double").alias("temperature"),
        F.timestamp_add("SECOND", F.greatest(F.col("id") - 2499, F.lit(0)), base).alias("ts"))


@pytest.mark.parametrize("keys", [["id"], []])
def test_rows_of_one_time_are_split(spark, target, keys):
    target(375)
    r = _one_time(spark)
    plan = resolve_chunking(r, keys, "ts", tiebreak=("seq",))
    sizes = [x["count"] for x in plan.apply(r, "ts").groupBy("__chunk").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 7 and max(sizes) < 2 * 375
    got = scan(r, keys, "ts", ["seq"], [Scan("n", "count", F.lit(1)), Scan("p", "prev", "seq")])
    assert got.where("n <> seq + 1 OR coalesce(p, -1) <> seq - 1").count() == 0 and got.count() == 3000


def test_only_equal_places_stay_together(spark, target):
    target(100)
    r = _one_time(spark).withColumn("seq", F.lit("same"))
    sizes = [x["count"] for x in resolve_chunking(r, [], "ts", tiebreak=("seq",)).apply(r, "ts").groupBy("__chunk").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) >= 2500


def test_many_cuts_are_searched_by_bisection(spark, monkeypatch):
    from eventide.operators import scan as S
    r = _one_time(spark)
    want = sorted(map(tuple, scan(r, [], "ts", ["seq"], [Scan("n", "count", F.lit(1))]).collect()))
    monkeypatch.setattr(S, "FEW_CUTS", 0)
    assert sorted(map(tuple, scan(r, [], "ts", ["seq"], [Scan("n", "count", F.lit(1))]).collect())) == want


def test_cuts_cost_one_read(spark):
    """Cuts are data of the plan: it holds no subquery that looks for them."""
    s = scan(events(spark, SF01), [], "ts", ["seq"], [Scan("m", "max_excl", "seq")])
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and plan.count("Relation [") == 2


# ------------------------------------------------------------------ folds

def joined_fold():
    return Fold(F.col("seq").cast("string"), lambda a, b: F.concat(a, F.lit(","), b))


def longest_fold():
    """Longest run of rising values, from the runs at a piece's ends."""
    return Fold(
        F.struct(F.lit(1).alias("n"), F.col("temperature").alias("first"), F.col("temperature").alias("last"),
                 F.lit(1).alias("head"), F.lit(1).alias("tail"), F.lit(1).alias("best")),
        lambda a, b: F.struct(
            (a["n"] + b["n"]).alias("n"), a["first"].alias("first"), b["last"].alias("last"),
            F.when((a["head"] == a["n"]) & (b["first"] > a["last"]), a["n"] + b["head"]).otherwise(a["head"]).alias("head"),
            F.when((b["tail"] == b["n"]) & (b["first"] > a["last"]), b["n"] + a["tail"]).otherwise(b["tail"]).alias("tail"),
            F.greatest(a["best"], b["best"], F.when(b["first"] > a["last"], a["tail"] + b["head"])).alias("best")),
        lambda s: s["best"])


def _longest(values):
    best = run = 1
    for a, b in zip(values, values[1:]):
        run = run + 1 if b > a else 1
        best = max(best, run)
    return best


@pytest.mark.parametrize("rows_per_chunk", [4_000_000, 50])
def test_folds_equal_plain_loops(spark, target, rows_per_chunk):
    target(rows_per_chunk)
    r = events(spark, SF01).withColumn("id", F.when(F.col("seq") % 3 > 0, F.col("id") % 4))     # NULL has a third
    by_key = {}
    for x in sorted(r.collect(), key=lambda x: (x["ts"], x["seq"])):
        by_key.setdefault(x["id"], []).append(x)
    joined = {x["id"]: x["o"] for x in ordered_fold(r, "id", "ts", ["seq"], joined_fold(), "o").collect()}
    assert joined == {k: ",".join(str(x["seq"]) for x in v) for k, v in by_key.items()}
    runs = {x["id"]: x["o"] for x in ordered_fold(r, "id", "ts", ["seq"], longest_fold(), "o").collect()}
    assert runs == {k: _longest([x["temperature"] for x in v]) for k, v in by_key.items()}


def test_fold_of_null_states_and_empty_input(spark):
    r = events(spark, SF01).where("seq < 500")
    last = Fold(F.when(F.col("seq") % 2 == 0, F.col("seq")), lambda a, b: b)        # a state may be NULL
    got = {x["id"]: x["o"] for x in ordered_fold(r, "id", "ts", ["seq"], last, "o").collect()}
    want = {}
    for x in sorted(r.collect(), key=lambda x: (x["ts"], x["seq"])):
        want[x["id"]] = x["seq"] if x["seq"] % 2 == 0 else None
    assert got == want
    assert window_fold(r.where("false"), "id", "ts", "1 day", ["seq"], joined_fold(), "o").count() == 0


def test_fold_plan_gathers_no_group(spark):
    plan = window_fold(events(spark, SF01), "id", "ts", "1 day", ["seq"], joined_fold(), "o")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1        # no key is hot here


# --------------------------------------------------------------- back-fill

def _accumulator():
    v = F.col("temperature")
    return Accumulator(add={"n": (F.lit(1), F.count), "sum": (v, F.sum), "high": (v, F.max), "low": (v, F.min)},
                       result={"cnt": lambda s: s["n"], "mean": lambda s: F.round(s["sum"] / s["n"], 6), "high": lambda s: s["high"], "low": lambda s: s["low"]})


def _tagged(spark):
    arrival = F.timestamp_add("MINUTE", (F.col("seq") * 37 % 120).cast("int"), F.col("ts"))
    r = events(spark, SF01).withColumn("id", F.when(F.col("id") % 5 > 0, F.col("id") % 5)).withColumn("arrival", arrival)
    return r, L.window_lateness(r, "id", "ts", "arrival", "seq", "30 minutes", "1 hour")


def test_merged_states_equal_all_rows(spark, tmp_path):
    r, tagged = _tagged(spark)
    acc = _accumulator()
    states = L.window_states(tagged, "id", acc)
    states.write.partitionBy("is_late").parquet(str(tmp_path / "s"))
    held = spark.read.schema(states.schema).parquet(str(tmp_path / "s"))
    on_time, late = held.where("NOT is_late").drop("is_late"), held.where("is_late").drop("is_late")
    assert late.count() > 100
    merged = L.backfill(on_time, late, "id", acc)
    # rows are not read again: the plan reads the states' files alone
    assert merged.inputFiles() and all("/s/is_late=" in f for f in merged.inputFiles())
    want = window_accumulate(r, "id", "ts", "1 hour", acc)
    got = acc.finish(merged).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a second back-fill goes on from the merged states
    again = L.backfill(L.backfill(on_time, late.where("id IS NULL"), "id", acc), late.where("id IS NOT NULL"), "id", acc)
    again = acc.finish(again).select(*want.columns)
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0


def test_states_that_cannot_merge_are_worked_out_again(spark):
    r, tagged = _tagged(spark)
    acc = Accumulator(add={"mean": (F.col("temperature"), F.avg)}, result={"mean": lambda s: s["mean"]})
    assert not acc.mergeable
    with pytest.raises(ValueError, match="mean"):
        L.backfill(tagged, tagged, "id", acc)
    median = [F.median("temperature").alias("mid")]
    published = tagged.where("fate = 'on_time'").groupBy("id", "window_end").agg(*median)
    fixed = L.recompute(published, tagged.where("fate <> 'on_time'").select("id", "ts"), r.select("id", "ts", "temperature"), "id", "ts", "1 hour", median)
    want = tagged.groupBy("id", "window_end").agg(*median)
    assert fixed.exceptAll(want).count() == 0 and want.exceptAll(fixed).count() == 0


def test_user_merges(spark):
    acc = Accumulator(add={"n": (F.lit(1), F.count), "ids": (F.col("seq"), F.collect_set)}, result={"n": lambda s: s["n"]},
                      merge={"ids": lambda s: F.array_distinct(F.flatten(F.collect_list(s)))})
    assert acc.mergeable
