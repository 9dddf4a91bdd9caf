"""Import the entry module by path from another working directory (no
PYTHONPATH), as a driver may, and run queries that need Python workers."""

import importlib.util
import json
import sys

spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)

from pyspark.sql import SparkSession  # noqa: E402

spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
q = E.queries()
print(json.dumps({"rising": q["rising_alert"](spark, sys.argv[2]).count(),
                  "entry": E.entry(spark).count()}))
