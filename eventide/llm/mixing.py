"""Mixing sources to target weights with soft domain membership, in DataFrame
operations only.

A table of labelled documents teaches a classifier: softmax regression over
the hashed tokens that tell domains apart beyond chance (chi-squared), by
gradients summed over a bounded, balanced sample and corrected to the domains'
true shares.  Every document then has a posterior over the domains and a
rate, how often it is to be read.  The expected tokens of a domain are the sum
of rate x tokens x posterior; rates minimise the squared distance of these
totals to the targets by projected gradient: in each step the distributed
totals come in as one small row, and every rate moves by its document's
posterior times the relative shortfalls, never below zero.  The step length is
the Barzilai-Borwein one of the last move.

Cases: a null text or one without tokens has the prior as posterior, no weight
in any total, and a rate like others; without labelled rows all posteriors are
uniform; domains whose totals cannot meet their targets get as close as rates
allow; equal rows have equal rates; an empty table gives no rows.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm._text import fresh
from eventide.llm.components import stored

BUCKETS = 1 << 18
SAMPLE_ROWS = 4000      # bound on labelled rows of each domain
LEAST_DOCS = 3          # of the sample that must have a kept token
LEAST_CHI2 = 20.0       # of a kept token against one domain; all such are kept
TURNS, PACE, DECAY = 40, 0.5, 1e-4      # gradient steps, their length, weight decay
TOLERANCE = 1e-4        # of all tokens, that a domain may miss its target by
STILL = 1e-7            # of a rate's mean move, that ends a fit whose targets are out of reach
STEPS = 60
CUT = 8                 # steps between written states

log = logging.getLogger(__name__)

SPACE = r"[\x20\x09-\x0D]+"


def _tokens(text):
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda t: t != "")


def _present(tokens):
    return F.array_distinct(F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int")))


def sample_labels(labelled: DataFrame, domains: list[str], rows: int) -> tuple[DataFrame, dict[str, int]]:
    """A bounded share of ``(doc_id, domain)``, about ``rows`` of each domain
    by a hash of doc_id, and how many rows each domain has in all."""
    known = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).dropDuplicates(["doc_id"])
    counts = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return known.limit(0), counts
    odds = F.create_map(*[F.lit(v) for d, n in sorted(counts.items()) for v in (d, rows / n)])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return known.where(draw < odds[F.col("domain")]), counts


def telling(present: DataFrame, domains: list[str], size: dict[str, int]) -> DataFrame:
    """The buckets of ``(domain, bucket)``, a row for each text that has it,
    that tell domains apart."""
    total = max(1, sum(size.values()))
    counts = present.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum((F.col("domain") == d).cast("long")).alias(f"n{k}") for k, d in enumerate(domains)])
    chi2 = [F.lit(0.0)]
    for k, d in enumerate(domains):
        p = size.get(d, 0) / total
        expected = F.col("n") * p
        off = F.col(f"n{k}") - expected
        chi2.append(off * off / F.greatest(expected * (1 - p) * (total - F.col("n")) / total, F.lit(1e-9)))
    told = counts.withColumn("chi2", F.greatest(*chi2) if domains else chi2[0]).where(
        (F.col("n") >= LEAST_DOCS) & (F.col("chi2") >= LEAST_CHI2))
    return told.select("bucket")


def summed(places: str, values):
    """Sum of ``values`` at the places an array column lists."""
    return F.aggregate(places, F.lit(0.0), lambda s, i: s + F.get(values, i))


def fitted(taught: DataFrame, domains: list[str]) -> DataFrame:
    """``(bucket, l0, l1, ...)``: bucket -1, which every text has, and the
    telling ones, with a weight for each domain, from ``(doc_id, domain,
    present)``.

    Weights stay a table of at most BUCKETS + 1 rows: a turn reads it as one
    row of arrays, adds the gradients of all texts up by bucket, and writes the
    next one, so neither the driver nor a plan holds them.
    """
    labels = range(len(domains))
    size = {r["domain"]: r["n"] for r in taught.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = taught.select("doc_id", "domain", F.explode("present").alias("bucket"))
    state = stored(telling(rows, domains, size).agg(F.sort_array(F.collect_list("bucket")).alias("b"))
                   .select(F.posexplode(F.concat(F.array(F.lit(-1)), F.col("b"))).alias("i", "bucket"))
                   .select("i", "bucket", *[F.lit(0.0).alias(f"l{k}") for k in labels],
                           *[F.lit(1e-8).alias(f"s{k}") for k in labels]), "mixing-weights")
    weights = [f"l{k}" for k in labels]
    if not size:
        return state.select("bucket", *weights)
    texts = stored(taught.select("doc_id", "domain", F.explode(F.concat(F.array(F.lit(-1)), F.col("present"))).alias("bucket"))
                   .join(F.broadcast(state.select("i", "bucket")), "bucket")      # at most BUCKETS + 1 rows
                   .groupBy("doc_id", "domain").agg(F.collect_list("i").alias("has")), "mixing-taught")
    total = sum(size.values())
    for _ in range(TURNS):
        listed = state.agg(F.sort_array(F.collect_list(F.struct("i", *weights))).alias("w"))
        now = listed.select(F.struct(*[F.col(f"w.{c}").alias(c) for c in weights]))
        held = texts.select("domain", "has", now.scalar().alias("w"))
        scored = held.select("domain", "has", *[summed("has", F.col("w")[c]).alias(f"z{k}") for k, c in enumerate(weights)])
        p = softmax([F.col(f"z{k}") for k in labels])
        off = scored.select(F.explode("has").alias("i"), *[(v - (F.col("domain") == d).cast("double")).alias(f"g{k}")
                                                          for k, (v, d) in enumerate(zip(p, domains))])
        sums = off.groupBy("i").agg(*[(F.sum(f"g{k}") / total).alias(f"g{k}") for k in labels])
        slope = [F.coalesce(f"g{k}", F.lit(0.0)) + DECAY * F.col(f"l{k}") for k in labels]
        moved = state.join(sums, "i", "left").select("i", "bucket", *weights, *[g.alias(f"g{k}") for k, g in enumerate(slope)],
                                             *[(F.col(f"s{k}") + g * g).alias(f"s{k}") for k, g in enumerate(slope)])
        state = stored(moved.select("i", "bucket", *[(F.col(f"l{k}") - PACE * F.col(f"g{k}") / F.sqrt(f"s{k}")).alias(f"l{k}") for k in labels],
                                    *[f"s{k}" for k in labels]), "mixing-weights")
    return state.select("bucket", *weights)


def learn(taught: DataFrame, domains: list[str]) -> tuple[list[int], list[list[float]]]:
    """What ``fitted`` finds as lists: buckets, and their weights for each
    domain, at most BUCKETS + 1 of them."""
    found = fitted(taught, domains).orderBy("bucket").collect()
    return [r["bucket"] for r in found], [[r[f"l{k}"] for r in found] for k in range(len(domains))]


def softmax(z: list) -> list:
    top = F.greatest(*z) if len(z) > 1 else z[0]
    e = [F.exp(v - top) for v in z]
    total = sum(e[1:], e[0])
    return [v / total for v in e]


def evidence(texts: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """``(doc_id, text, ...)`` -> one row for each distinct (doc_id, text):
    its tokens, how many equal rows it stands for, and the summed log-rates."""
    words = _tokens(F.col("text"))
    split = texts.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words.alias("words"))
    # columns first, rows then: what stands beside an explode is worked out for each of its rows
    split = split.select("doc_id", "text_hash", F.size("words").alias("tokens"), _present(F.col("words")).alias("present"))
    rows = split.select("doc_id", "text_hash", "tokens",     # bucket -1 stands for the row itself
                        F.explode(F.concat(F.array(F.lit(-1)), F.col("present"))).alias("bucket"))
    met = rows.join(F.broadcast(table), "bucket")       # at most BUCKETS + 1 rows
    copies = F.sum((F.col("bucket") < 0).cast("long"))
    return met.groupBy("doc_id", "text_hash", "tokens").agg(
        copies.alias("copies"), *[(F.sum(f"l{k}") / copies).alias(f"l{k}") for k in range(n)])


def memberships(docs: DataFrame, labelled: DataFrame, domains: list[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, text_hash, tokens, copies, p0, p1, ...)`` of the documents
    ``(doc_id, text)``; ``labelled(doc_id, domain)`` names some of them."""
    n = len(domains)
    sample, counts = sample_labels(labelled, domains, rows)
    taught = stored(docs.where("doc_id IS NOT NULL").join(F.broadcast(sample), "doc_id")    # at most rows x domains
                    .select("doc_id", "domain", _present(_tokens(F.col("text"))).alias("present")), "mixing-sample")
    table = fitted(taught, domains)
    # from the sample's shares to those of all labelled rows
    total = sum(counts.values())
    shift = [math.log((counts.get(d, 0) + 1) / (total + n)) - math.log((min(counts.get(d, 0), rows) + 1)) for d in domains]
    p = softmax([F.col(f"l{k}") + s for k, s in enumerate(shift)])
    return evidence(docs, table, n).select("doc_id", "text_hash", "tokens", "copies",
                                           *[v.alias(f"p{k}") for k, v in enumerate(p)])


def fit_rates(members: DataFrame, targets: list[float], steps: int = STEPS, tolerance: float = TOLERANCE,
              cut: int = CUT, fail_over: float | None = None) -> DataFrame:
    """``members`` with ``rate``: nonnegative, its domain totals as near to
    ``targets`` (shares of all tokens) as can be.  The fit ends when every
    domain is within ``tolerance`` of all tokens or the rates stand still; if
    they still move after ``steps`` steps, the share of tokens still missing
    is logged as a warning, and over ``fail_over`` it is an error."""
    n = len(targets)
    weight = F.col("tokens") * F.col("copies")
    p = [F.col(f"p{k}") for k in range(n)]

    def step(rate, move):
        return F.greatest(F.lit(0.0), rate + sum((c * F.get(move, F.lit(k)) for k, c in enumerate(p)), F.lit(0.0)))

    def after(moves):
        """The rate after these moves; they are data of the plan, so every
        step runs the code compiled for the first."""
        listed = F.array(*[F.array(*map(F.lit, m)) for m in moves]) if moves else F.array().cast("array<array<double>>")
        return F.aggregate(listed, F.col("rate"), step)

    state = stored(members.withColumn("rate", F.lit(1.0)), "mixing-rates")
    moves: list[list[float]] = []
    old = goal = natural = None
    for turn in range(steps + 1):
        pair = state.withColumn("before", after(moves[:-1])).withColumn(
            "now", step(F.col("before"), F.array(*map(F.lit, moves[-1]))) if moves else F.col("before"))
        gone = F.col("now") - F.col("before")
        row = pair.agg(*[F.sum(weight * F.col("now") * c).alias(f"e{k}") for k, c in enumerate(p)],
                       F.sum(weight * gone * gone).alias("moved")).first()
        got = [row[k] or 0.0 for k in range(n)]
        if natural is None:
            natural, total = got, sum(got)
            goal = [t / sum(targets) * total for t in targets]
        miss = max(abs(g - e) for g, e in zip(goal, got)) / total if total else 0.0
        if miss <= tolerance or (moves and (row["moved"] or 0.0) <= STILL ** 2 * total):
            break
        if turn == steps:
            said = f"rates still move after {steps} steps: a domain misses its target by {miss:.2e} of all tokens"
            if fail_over is not None and miss > fail_over:
                raise RuntimeError(said)
            log.warning(said)
            break
        # distances in units of a domain's own tokens: then a step of length 1 never overshoots
        unit = [max(w, 1e-9 * total) for w in natural]
        change = 0.0 if old is None else sum((e - o) ** 2 / w for e, o, w in zip(got, old, unit))
        length = min(max((row["moved"] or 0.0) / change, 1.0), 100.0) if change > 0 else 1.0
        old = got
        if len(moves) == cut:
            state, moves = stored(pair.withColumn("rate", F.col("now")).drop("before", "now"), "mixing-rates"), []
        moves.append([length * (g - e) / w for g, e, w in zip(goal, got, unit)])
    return pair.withColumn("rate", F.col("now")).drop("before", "now")


def copies_of(rate, doc_id, seed: int = 11):
    """Whole copies whose mean over documents is the rate: it is rounded up
    with the odds of its fraction, by a hash of doc_id."""
    draw = F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + draw).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``docs``, every row as many times as its rate says (none if that is 0)."""
    domains = sorted(targets)
    found = fit_rates(memberships(docs.select("doc_id", "text"), labelled, domains), [targets[d] for d in domains])
    of_id, of_text, n, copy = fresh(docs.columns, "__id", "__of", "__n", "__copy")
    rated = stored(found.select(F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_text),
                                copies_of(F.col("rate"), F.col("doc_id")).alias(n)), "mixing-copies")
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(of_text))
    return (docs.join(rated.where(F.col(n) > 0), same)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
