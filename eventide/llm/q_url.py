"""op8: every page's url judged; outcomes come from ``labels``: the number
that ends a page url's path names the document its text was taken from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import url_filter as U
from eventide.llm._text import LOWER, UPPER
from eventide.llm.registry import query

DOC_IN_PATH = r"/([0-9]{1,18})(?:\.[a-z]+)?/?$"


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(page_id, good)``: good if the page's document is of quality 1 and
    not toxic."""
    _, path = U.host_and_path(F.col("url"))
    named = pages.select("page_id", F.regexp_extract(path, DOC_IN_PATH, 1).alias("d")).where("d <> ''")
    marks = labels.where("quality IS NOT NULL").select(
        F.col("doc_id").alias("of"),
        ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("int").alias("good"))
    return named.select("page_id", F.col("d").cast("long").alias("of")).join(marks, "of").select("page_id", "good")


def _sql() -> str:
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN "
            for r in sorted(U.RULES, key=lambda r: -len(r.text))]
    rule = " ".join(f + f"'{r.text}'" for f, r in zip(fits, sorted(U.RULES, key=lambda r: -len(r.text))))
    said = " ".join(f + f"'{r.verdict}'" for f, r in zip(fits, sorted(U.RULES, key=lambda r: -len(r.text))))
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"

    def level(name: str, above: str | None, cols: str) -> str:
        prior = "(SELECT base FROM root)" if above is None else f"{above}_p.mean"
        join = "" if above is None else f" JOIN {above}_p USING ({above})"
        return f"""
{name}_c AS (SELECT {cols}, sum(y) AS y, sum(n) AS n FROM hosts GROUP BY ALL),
{name}_m AS (SELECT {name}_c.*, {prior} AS m FROM {name}_c{join}),
{name}_f AS (SELECT sum(n) AS w, sum(n * (y / n - m) * (y / n - m)) AS ss, sum(m * (1 - m)) AS within_,
  sum(n * m * (1 - m)) AS spread FROM {name}_m WHERE n > 0),
{name}_k AS (SELECT CASE WHEN coalesce(w, 0) = 0 OR spread <= within_ THEN {U.STRONGEST}
  WHEN (ss - within_) / (spread - within_) <= 1 / ({U.STRONGEST} + 1) THEN {U.STRONGEST}
  ELSE greatest({U.WEAKEST}, 1 / least((ss - within_) / (spread - within_), 1.0) - 1) END::DOUBLE AS k FROM {name}_f),
{name}_p AS (SELECT *, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS sd FROM (
  SELECT *, k * m + y AS a, k * (1 - m) + n - y AS b FROM {name}_m, {name}_k))"""

    return f"""
WITH parsed AS (
  SELECT page_id, {lower.format("regexp_extract(tail, '^([^/?#]*)', 1)")} AS host,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages)),
marks AS (SELECT page_id, sum(good) AS y, count(*) AS n FROM (
  SELECT page_id, (quality = 1 AND coalesce(toxic, 0) = 0)::INT AS good
  FROM parsed JOIN labels ON labels.doc_id = try_cast(regexp_extract(path, '{DOC_IN_PATH}', 1) AS BIGINT)
  WHERE quality IS NOT NULL) GROUP BY page_id),
hosts AS (SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
  coalesce(sum(y), 0)::DOUBLE AS y, coalesce(sum(n), 0)::DOUBLE AS n
  FROM parsed LEFT JOIN marks USING (page_id) GROUP BY host),
root AS (SELECT (coalesce(sum(y), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS base FROM hosts),
{level("suffix", None, "suffix")},
{level("domain", "suffix", "domain, suffix")},
{level("host", "domain", "host, domain")},
judged AS (SELECT parsed.*, least(1.0, mean + {U.Z} * sd) AS upper FROM parsed JOIN host_p USING (host))
SELECT page_id, host, path, CASE {rule} END AS rule,
  coalesce(CASE {said} END, CASE WHEN upper < {U.MIN_GOOD} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged"""


@query("op8_url_filter", _sql())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return U.judge(pages, page_outcomes(pages, labels)).select("page_id", "host", "path", "rule", "verdict")
