from eventide.plans.catalog import CATALOG, spark_queries, oracle_queries  # noqa: F401
