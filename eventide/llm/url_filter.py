"""URL filter by empirical-Bayes host reputation.

Outcomes of labelled pages are counted by host and summed up to registered
domain, suffix and root.  From the root down, every node's good rate gets a
beta posterior whose prior is its parent's posterior mean, with a strength
fitted to how much siblings of that level really differ (beta-binomial method
of moments).  A host is blocked if the upper bound of its posterior stays
under ``min_good``: few or no labels never block a host by themselves, they
leave it with what its domain and suffix show.  Written rules come first; the
longest that fits decides.

Only aggregates and joins run: counts combine before the shuffle, pages meet
one small row for each host, and three fitted numbers come to the driver.

Suffix is a host's last label, registered domain its last two.  Cases: a null
url or one without ``://`` has empty host and path, fits no rule and is judged
as the host ''; outcomes that are null or of unknown pages count nothing;
without any outcome the root's prior is 1/2 of strength 1; repeated rows
return repeated; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm._text import LOWER, UPPER
from eventide.llm.components import stored

Z = 1.645               # one-sided 95 % bound
MIN_GOOD = 0.5
WEAKEST, STRONGEST = 1.0, 1000.0   # range of a prior's strength, in pages


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"),
         Rule("www.example.com", "/en/", "allow"), Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))


def host_and_path(url):
    """Expressions for a url's host (A-Z lower-cased) and path."""
    tail = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    tail = F.coalesce(tail, F.lit(""))
    return (F.translate(F.regexp_extract(tail, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1))


def suffix_of(host):
    return F.element_at(F.split(host, r"\."), -1)


def domain_of(host):
    parts = F.split(host, r"\.")
    return F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2))


LEVELS = ("suffix", "domain", "host")


def reputation(outcomes: DataFrame) -> DataFrame:
    """``(host, domain, suffix, n, y)`` counts -> one row for each host with
    its posterior ``mean`` and ``sd``."""
    root = outcomes.agg(F.sum("y").alias("y"), F.sum("n").alias("n")).first()
    base = ((root["y"] or 0) + 0.5) / ((root["n"] or 0) + 1.0)
    parents = None
    for level, above in zip(LEVELS, (None, *LEVELS)):
        up = [above] if above else []
        nodes = outcomes.groupBy(level, *up).agg(F.sum("y").alias("y"), F.sum("n").alias("n"))
        nodes = nodes.withColumn("m", F.lit(base)) if parents is None else nodes.join(
            parents.select(F.col(above), F.col("mean").alias("m")), above)
        seen = nodes.where("n > 0").select("n", "m", (F.col("y") / F.col("n")).alias("p"))
        fit = seen.agg(
            F.sum("n").alias("w"),
            F.sum(F.col("n") * (F.col("p") - F.col("m")) * (F.col("p") - F.col("m"))).alias("ss"),
            F.sum(F.col("m") * (1 - F.col("m"))).alias("within"),
            F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("spread")).first()
        k = strength(fit["w"], fit["ss"], fit["within"], fit["spread"])
        a, b = F.lit(k) * F.col("m") + F.col("y"), F.lit(k) * (1 - F.col("m")) + F.col("n") - F.col("y")
        parents = nodes.select(level, *up, (a / (a + b)).alias("mean"),
                               F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))).alias("sd"))
    return parents.select("host", "mean", "sd")


def strength(w, ss, within, spread) -> float:
    """Prior strength of a level from the spread of its nodes' rates about
    their parents' beyond what counting alone gives (see the module)."""
    if not w or spread <= within:
        return STRONGEST
    extra = (ss - within) / (spread - within)     # 1 / (strength + 1)
    return STRONGEST if extra <= 1 / (STRONGEST + 1) else max(WEAKEST, 1 / min(extra, 1.0) - 1)


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url",
          page_id: str = "page_id", min_good: float = MIN_GOOD, z: float = Z) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the host's posterior mean
    and upper bound.  ``outcomes(page_id, good)`` labels some of the pages;
    ``rules`` is a short written list and becomes part of the plan."""
    host, path = host_and_path(F.col(f"`{url}`"))
    new = ("host", "path", "rule", "verdict", "host_mean", "host_upper")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in new]
    parsed = pages.select(*kept, host.alias("host"), path.alias("path"))
    marks = outcomes.where("page_id IS NOT NULL AND good IS NOT NULL").groupBy("page_id").agg(
        F.sum(F.col("good").cast("long")).alias("y"), F.count(F.lit(1)).alias("n"))
    hosts = parsed.select("host", F.col(f"`{page_id}`").alias("page_id")).join(marks, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("y"), F.lit(0)).alias("y"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    hosts = hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "y", "n")
    hosts = stored(hosts, "url-hosts")
    known = reputation(hosts).select(
        "host", F.col("mean").alias("host_mean"),
        F.least(F.lit(1.0), F.col("mean") + F.lit(z) * F.col("sd")).alias("host_upper"))

    def first_fit(value):
        tests = None
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
            fits = ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))) \
                & F.startswith(F.col("path"), F.lit(r.path))
            tests = (F if tests is None else tests).when(fits, F.lit(value(r)))
        return F.lit(None).cast("string") if tests is None else tests

    own = F.when(F.col("host_upper") < min_good, "block").otherwise("allow")
    return parsed.join(known, "host").select(
        *kept, "host", "path", first_fit(lambda r: r.text).alias("rule"),
        F.coalesce(first_fit(lambda r: r.verdict), own).alias("verdict"), "host_mean", "host_upper")
