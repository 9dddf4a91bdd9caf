"""Run in a fresh process with task retries allowed: the first attempt of
one task fails; the query must still return exactly the batch result."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from eventide.session import get_session  # noqa: E402


def main():
    spark = get_session("local[4,3]", shuffle_partitions=4)
    from eventide.operators import alerts as A
    from eventide.plans.catalog import spark_queries
    from eventide.plans.common import events

    @F.udf(T.DoubleType())
    def flaky(v):
        from pyspark import TaskContext
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == 0:
            raise RuntimeError("injected executor loss")
        return v

    sf = sys.argv[1]
    r = events(spark, sf)
    flaky_r = r.withColumn("temperature", flaky("temperature"))
    got = sorted(tuple(x) for x in A.rising_alert(flaky_r, "id", "1 hour", chunk="2 days").collect())
    want = sorted(tuple(x) for x in A.rising_alert(r, "id", "1 hour", chunk="2 days").collect())
    s_got = spark_queries()["win_session"]
    print(json.dumps({"same": got == want, "n": len(want),
                      "session_rows": s_got(spark, sf).count()}))


if __name__ == "__main__":
    main()
