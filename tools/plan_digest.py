"""Write docs/plans.md: the physical operators of selected queries at
$PLAN_SF_DIR (default sf0.1), and of a scan over input where one key holds a
third of the rows (hot-key path)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"(Exchange|Window|Aggregate|Join|Scan|Generate|MapInPandas|Expand|Union|"
                  r"BroadcastExchange|Sort\b)")


def digest(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            out.append(line[:150])
    return "\n".join(out)


def main() -> None:
    from pyspark.sql import functions as F

    from eventide.operators.scan import Scan, scan
    from eventide.plans.catalog import spark_queries
    from eventide.plans.common import events
    from eventide.session import get_session

    sf = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session("local[8]", shuffle_partitions=8)
    qs = spark_queries()
    parts = ["# Physical plans (digest)", "",
             f"Generated by `tools/plan_digest.py` on `{sf}`; operator lines only.", ""]
    for name in ["win_tumbling_avg", "word_count", "rolling_sum", "win_session", "rising_alert",
                 "interval_join", "window_join", "fire_alert", "early_firing"]:
        parts += [f"## {name}", "", "```", digest(qs[name](spark, sf)), "```", ""]
    spark.conf.set("spark.eventide.scan.targetRowsPerChunk", str(max(1000, 10)))
    r = events(spark, sf)
    hot = r.withColumn("id", F.when(F.pmod("seq", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("id")))
    df = scan(hot, ["id"], "ts", ["seq"], [Scan("s", "sum", "temperature")])
    parts += ["## rolling sum, one key with a third of the rows (target 1000 rows/chunk)", "",
              "Only the hot key is cut finer (broadcast table of hot keys), the carry is a",
              "one-row-per-chunk aggregate joined back on (key, chunk).", "",
              "```", digest(df), "```", ""]
    spark.conf.unset("spark.eventide.scan.targetRowsPerChunk")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans.md"),
              "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
