"""Toxicity by a factorization machine over hashed terms.

A text's features are the distinct hashes of its words and of the beginnings
of its longer words (forms of a word that are rare share these).  The machine adds a
weight for each term and, for each pair of terms, the product of their latent
factors, so an insult next to a group's name can count for more than both
alone.  It is trained in numpy on the driver from a bounded sample of labelled
rows (both classes alike, the bias corrected to the true share) and applied in
Arrow batches on the executors.

Cases: a null or empty text, or one without a known term, scores what the bias
says; without labels of both classes every score is their share (0 if there
is none); rows repeat as they come; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm._text import split_words
from eventide.llm.components import stored
from eventide.llm.langid import parts

BUCKETS = 1 << 20
SAMPLE_ROWS = 5000      # bound on training rows of each class
LEAST_DOCS = 3          # of the sample that must have a kept term
LEAST_CHI2 = 20.0       # a kept term's association with the label, beyond chance; all such are kept
FACTORS = 8
BEGINNINGS = (4, 5)     # bytes of a longer word that are terms too
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every text's terms (repeats included), and how many each
    text has."""
    words = split_words(column)
    count = np.diff(words.first)
    if len(words.offsets) == 1:
        return np.zeros(0, np.int64), count
    sizes, begin = np.diff(words.offsets), words.offsets[:-1]
    place = np.arange(len(words.data)) - np.repeat(begin, sizes)
    part = (words.data.astype(np.uint64) + np.uint64(1)) * np.cumprod(np.full(int(sizes.max()), _STEP))[place]
    rows, text = [_bucket(np.add.reduceat(part, begin), 0)], np.repeat(np.arange(len(count)), count)
    of = [text]
    for k in BEGINNINGS:
        longer = sizes > k
        start = begin[longer][:, None] + np.arange(k)
        rows.append(_bucket(part[start].sum(axis=1, dtype=np.uint64), k))
        of.append(text[longer])
    of, rows = np.concatenate(of), np.concatenate(rows)
    return rows[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(count))


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h + np.uint64(kind)) * _MIX
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return ((h >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


class Machine(NamedTuple):
    column: np.ndarray   # (BUCKETS,) row of the tables below, -1 for other terms
    bias: float
    weight: np.ndarray   # (terms,)
    factor: np.ndarray   # (terms, FACTORS)

    def margins(self, term: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        """Log-odds; ``text[i]`` has ``term[i]``, each pair once, texts ascending."""
        z = np.full(texts, self.bias)
        if len(term):
            some, begin = np.unique(text, return_index=True)
            v = self.factor[term]
            total, squares = np.add.reduceat(v, begin), np.add.reduceat(v * v, begin)
            z[some] += np.add.reduceat(self.weight[term], begin) + 0.5 * (total * total - squares).sum(axis=1)
        return z

    def score(self, column: pa.Array) -> np.ndarray:
        term, count = term_hashes(column)
        term = self.column[term]
        text = np.repeat(np.arange(len(column)), count)
        pairs = np.unique(text[term >= 0] * len(self.weight) + term[term >= 0])
        z = self.margins(pairs % max(1, len(self.weight)), pairs // max(1, len(self.weight)), len(column))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def telling(n: np.ndarray, pos: np.ndarray, texts: int, share: float) -> np.ndarray:
    """Which terms tell the labels apart, of those that ``n`` of the texts
    have and ``pos`` of those with label 1, a ``share`` of all."""
    expected = n * share
    chi2 = (pos - expected) ** 2 / np.maximum(expected * (1 - share) * np.maximum(texts - n, 1) / max(texts, 1), 1e-9)
    return (n >= LEAST_DOCS) & (chi2 >= LEAST_CHI2)


def train(rows: list[np.ndarray], labels: np.ndarray, share: float, steps: int = 1200, rate: float = 0.1,
          decay: float = 1e-4, batch: int = 128, seed: int = 5) -> Machine:
    """AdaGrad on the logistic loss of ``rows`` (each the distinct buckets of
    a text).  ``share`` is the true share of label 1, for the bias."""
    column = np.full(BUCKETS, -1, np.int32)
    share = min(max(share, 1e-6), 1 - 1e-6) if 0 < share < 1 else share
    if not len(labels) or labels.min() == labels.max():
        z = -40.0 if share <= 0 else 40.0 if share >= 1 else float(np.log(share / (1 - share)))
        return Machine(column, z, np.zeros(0), np.zeros((0, FACTORS)))
    text, bucket = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
    n, pos = np.bincount(bucket, minlength=BUCKETS), np.bincount(bucket[labels[text] == 1], minlength=BUCKETS)
    kept = np.flatnonzero(telling(n, pos, len(rows), labels.mean()))
    column[kept] = np.arange(len(kept), dtype=np.int32)
    lists = [column[r][column[r] >= 0] for r in rows]
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), FACTORS)), 0.0
    gw, gv, gb = np.full(len(kept), 1e-6), np.full((len(kept), FACTORS), 1e-6), 1e-6
    a_pass = -(-len(lists) // batch)
    for _ in range(-(-steps // a_pass)):
        order = rng.permutation(len(lists))
        for at in range(0, len(order), batch):
            rows_now = order[at:at + batch]
            some = [lists[k] for k in rows_now]
            term, of = np.concatenate(some), np.repeat(np.arange(len(some)), [len(s) for s in some])
            machine = Machine(column, b, w, v)
            z = machine.margins(term, of, len(some))
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[rows_now]) / len(some)
            total = np.zeros((len(some), FACTORS))
            np.add.at(total, of, v[term])
            used, back = np.unique(term, return_inverse=True)
            dw = np.bincount(back, g[of], len(used)) + decay * w[used]
            dv = np.zeros((len(used), FACTORS))
            np.add.at(dv, back, g[of][:, None] * (total[of] - v[term]))
            dv += decay * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += g.sum() ** 2
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= rate * dv / np.sqrt(gv[used])
            b -= rate * g.sum() / np.sqrt(gb)
    p = labels.mean()
    return Machine(column, float(b + np.log(share / (1 - share)) - np.log(p / (1 - p))), w, v)


def training_rows(docs: DataFrame, labels: DataFrame,
                  rows: int = SAMPLE_ROWS) -> tuple[list[np.ndarray], np.ndarray, float]:
    """A bounded sample of the documents ``(doc_id, text)`` named by
    ``labels(doc_id, label)``, at most ``rows`` of each label, those of the
    smallest hashes; and the true share of label 1 over all labels.  A row is
    the telling term buckets of its whole text: terms are counted by label in
    Spark, and no others come to the driver."""
    labels = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("label").cast("int"))
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return [], np.zeros(0, np.int64), 0.0

    def least(df: DataFrame, *order) -> DataFrame:
        return reduce(DataFrame.union, [df.where(F.col("label") == k).orderBy(*order).limit(rows) for k in sorted(counts)])

    odds = F.create_map(*[F.lit(v) for k in sorted(counts) for v in (k, 2 * rows / counts[k])])     # of those to order
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = least(labels.where(draw < odds[F.col("label")]).distinct(), draw, "doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at, part in parts(batch.column("text")):
                bucket, count = term_hashes(part)
                ends = np.cumsum(count)
                held = [np.unique(bucket[b - n:b]).astype(np.int32) for n, b in zip(count, ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(at, len(part)), batch.column("place").slice(at, len(part)),
                     pa.array(held, pa.list_(pa.int32()))], names=["label", "place", "terms"])

    named = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")     # at most 2 x rows
    terms = named.select("label", F.xxhash64("doc_id", "text").alias("place"), "text").mapInArrow(
        hashed, "label int, place long, terms array<int>")
    sample = stored(least(terms, "place", "terms"), "toxicity-sample")     # ids may repeat in docs
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = (sample.select("label", F.explode("terms").alias("bucket")).groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).where(F.col("n") >= LEAST_DOCS).toArrow())
    size = sum(sizes.values())
    found = telling(seen["n"].to_numpy(), seen["pos"].to_numpy(), size, sizes.get(1, 0) / max(size, 1))
    known = np.zeros(BUCKETS, bool)
    known[seen["bucket"].to_numpy()[found]] = True

    def telling_only(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = [np.asarray(t.values, np.int32) for t in batch.column("terms")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([t[known[t]].tobytes() for t in lists], pa.binary())], names=["label", "terms"])

    taken = sorted((r["label"], bytes(r["terms"])) for r in
                   sample.select("label", "terms").mapInArrow(telling_only, "label int, terms binary").collect())
    return ([np.frombuffer(t, np.int32).astype(np.int64) for _, t in taken],
            np.array([k for k, _ in taken], dtype=np.int64), counts.get(1, 0) / total)


def score(docs: DataFrame, machine: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; a column of this name is replaced."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(np.concatenate([machine.score(part) for _, part in parts(column)] or [np.zeros(0)]))

    kept = [F.col(f"`{c}`") for c in docs.columns if c != name]
    return docs.select(*kept, F.arrow_udf(run, "double")(F.col(f"`{text}`")).alias(name))
