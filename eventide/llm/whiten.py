"""Whitening of embeddings onto their leading principal components.

Vectors become whole numbers, so distinct ones, sums and products are exact
whatever the partitioning.  Every task adds up the products of its rows,
centred at the whole number next to the mean, and hands on one number for
each pair of dimensions; what that centre is off the mean is taken off the
totals exactly.  Only the covariance (dimensions squared) comes to the driver,
where contour integration (``feast.py``) finds the leading components; these
are sent with the tasks that project all rows.

Cases: vectors that are null or hold null or non-finite entries take no part,
neither do those of another length than most vectors have; entries times 64
are held within 2^24; components of no variance (to rounding) are left out, so equal
vectors, a single one and an empty table give no rows; rows that repeat return
repeated, null ids too; a deviation of more than 63 bits is null; further
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import feast
from eventide.llm.components import stored
from eventide.llm.vectors import commonest_size, finite, floors

COMPONENTS = 16
FACTOR, PLUS = 64, 1_000_000
EXACT = float(1 << 53)
SLICE = 1 << 20             # numbers worked on in one go


@dataclass
class Fit:
    """Of the distinct vectors: their number, sums per dimension, the whole
    numbers they are centred at, and the components (columns)."""
    n: int
    sums: list[int]
    centre: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def off(self) -> list[int]:
        """``n`` times the mean's distance from the centre, per dimension."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened components of rows centred at ``centre``."""
        exact = np.array([o / self.n for o in self.off()])
        return ((y - exact) @ self.vectors) / np.sqrt(self.values)


def _rows(batches, dim: int):
    """Matrices of the column ``x``, a bounded number of rows each."""
    step = max(1, SLICE // max(dim, 1))
    for batch in batches:
        x = batch.column("x")
        for at in range(0, len(x), step):
            piece = x.slice(at, step)
            yield batch.slice(at, step), piece.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(piece), dim)


def _cells(values: list, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values, kind)], ["cell", "part"])


def _totals(fit_list: DataFrame, work, kind: str) -> list:
    """Sum over all tasks of the numbers that each hands on, by cell."""
    got = fit_list.mapInArrow(work, f"cell int, part {kind}").groupBy("cell").agg(F.sum("part").alias("total")).collect()
    return [r["total"] for r in sorted(got, key=lambda r: r["cell"])]


def _sums(dim: int):
    def work(batches):
        n, total = 0, [0] * dim
        for _, x in _rows(batches, dim):
            n += len(x)
            total = [t + int(s) for t, s in zip(total, x.sum(0))]
        yield _cells([n, *total], pa.int64())
    return work


def products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of whole numbers, exactly."""
    reach = int(np.abs(y).max(initial=0))
    if reach * reach * max(len(y), 1) < EXACT:          # exact as doubles
        wide = y.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = y.astype(object)
    return wide.T @ wide


def _products(centre: np.ndarray):
    upper = np.triu_indices(len(centre))

    def work(batches):
        total = np.zeros((len(centre), len(centre)), dtype=object)
        for _, x in _rows(batches, len(centre)):
            total = total + products(x - centre)
        yield _cells([str(int(v)) for v in total[upper]], pa.string())
    return work


def fit(fit_list: DataFrame, dim: int, components: int = COMPONENTS) -> Fit | None:
    """Components of the distinct vectors ``fit_list(x)``; None without rows."""
    n, *sums = [int(t) for t in _totals(fit_list, _sums(dim), "long")] or [0]
    if not n:
        return None
    sums = list(sums) or [0] * dim
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    cells = fit_list.mapInArrow(_products(centre), "cell int, part string").select("cell", F.col("part").cast("decimal(38,0)").alias("part"))
    totals = {r["cell"]: int(r["total"]) for r in cells.groupBy("cell").agg(F.sum("part").alias("total")).collect()}
    found = Fit(n, sums, centre, np.zeros(0), np.zeros((dim, 0)), 0.0)
    off, cov = found.off(), np.zeros((dim, dim))
    for cell, (i, j) in enumerate(zip(*np.triu_indices(dim))):
        # covariance times n^2 is whole: what the centre is off the mean goes out exactly
        cov[i, j] = cov[j, i] = (n * totals[cell] - off[i] * off[j]) / (n * n)
    found.values, found.vectors = feast.largest(cov, components)
    found.trace = float(np.trace(cov))
    return found


def _whitened_products(found: Fit):
    def work(batches):
        k = len(found.values)
        one, two = np.zeros(k), np.zeros((k, k))
        for _, x in _rows(batches, len(found.centre)):
            w = found.project(x - found.centre)
            one, two = one + w.sum(0), two + w.T @ w
        yield _cells([*one, *two.ravel()], pa.float64())
    return work


def identity_error(fit_list: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity, measured by a pass over it."""
    k = len(found.values)
    totals = np.array(_totals(fit_list, _whitened_products(found), "double"))
    mean = totals[:k] / found.n
    return float(np.abs(totals[k:].reshape(k, k) / found.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def deviations(y: np.ndarray, found: Fit) -> list:
    """Sum over dimensions of ``(n x - S)^2`` per row, exactly."""
    off = np.array(found.off(), dtype=object)
    reach = found.n * int(np.abs(y).max(initial=0)) + int(np.abs(off).max(initial=0))
    if reach * reach * max(y.shape[1], 1) < 1 << 63:
        return [int(v) for v in ((found.n * y - off.astype(np.int64)) ** 2).sum(1)]
    exact = ((found.n * y.astype(object) - off) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _whiten(found: Fit):
    def work(batches):
        k = len(found.values)
        share = found.values / found.trace
        for batch, x in _rows(batches, len(found.centre)):
            y = x - found.centre
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(deviations(y, found), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                 pa.array(found.project(y).ravel()), pa.array(np.tile(share, len(x)))],
                ["vec_id", "component", "deviation", "whitened", "explained"])
    return work


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)``: each vector that takes part on each component."""
    usable = rows.where(finite(vector))
    dim = commonest_size(usable, vector)
    whole = usable.where(F.size(f"`{vector}`") == dim).select(
        F.col(f"`{vec_id}`").alias("vec_id"), floors(vector, FACTOR, PLUS).alias("x"))
    fit_list = stored(whole.select("x").distinct(), "whiten-distinct")
    found = fit(fit_list, dim, components) if dim else None
    kind = rows.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, deviation long, whitened double, explained double"
    if found is None or not len(found.values):
        found, out = Fit(0, [], np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0), rows.sparkSession.createDataFrame([], schema)
        error = 0.0
    else:
        out, error = whole.mapInArrow(_whiten(found), schema), identity_error(fit_list, found)
    return out.select("vec_id", "component", F.lit(found.n).cast("long").alias("n"), "deviation", "whitened", "explained",
                      F.lit(error).alias("identity_error"))
