"""Nearest neighbours with a hash-prefix forest.

Every tree gives a vector a long bit string, the sides of random hyperplanes
it lies on.  Rows are dealt into segments of bounded size by a hash of their
id; a segment keeps, for each tree, its rows' strings as a sorted array.  A
query descends in each array to the rows with the longest common prefix, then
all trees ascend together, one bit at a time, and each level's new rows are
measured exactly.  Ascending ends for a query once a row nearer than its k-th
best could have stayed unseen in all trees with a chance of at most ``miss``
(worked out from the angle such a row has at least); at prefix length zero all
rows have been seen.  Each query's best of all segments are merged.

Queries come in blocks of bounded size, so a task holds one segment and one
block whatever the tables' sizes, and equal vectors spread over all segments.

Distance is Euclidean: vectors get one more coordinate, the spread of the
norms (zero for unit vectors), so that angles follow distances for vectors of
any norm.  Cases: vectors that are null, zero, or hold null or non-finite
components take no part; vectors of other lengths than a query's are no
candidates; fewer than k candidates give all; ties go to the smaller id; equal
rows count once, an id with several vectors is as near as its nearest, and a
query never finds its own id; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.components import stored

TREES = 48
BITS = 48                   # of each tree's strings
MISS = 0.05                 # chance of missing a true neighbour
SEGMENT_ROWS = 16_384
BLOCK_ROWS = 4_096          # queries
SEED = 20


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, v, norm, dim)`` of the rows that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return (rows.where(v.isNotNull() & finite).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"))
            .withColumn("norm", norm).withColumn("dim", F.size("v")).where("norm > 0 AND vec_id IS NOT NULL").dropDuplicates(["vec_id", "v"]))


def planes(dim: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """(trees, bits, dim) normals, the same in every task."""
    return np.random.default_rng([SEED, dim]).standard_normal((trees, bits, dim)).astype(np.float32)


def strings(x: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """(trees, rows) bit strings, first bit highest, as unsigned numbers."""
    weights = (np.uint64(1) << np.arange(normals.shape[1], dtype=np.uint64)[::-1])
    return np.stack([((x @ n.T) > 0).astype(np.uint64) @ weights for n in normals])


class Forest:
    """The sorted arrays of one segment."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lift: float):
        self.ids, self.vectors, self.lift = ids, vectors, lift
        lifted = self.lifted(vectors)
        self.normals = planes(lifted.shape[1])
        made = strings(lifted.astype(np.float32), self.normals)
        self.order = np.argsort(made, axis=1, kind="stable")
        self.sorted = np.take_along_axis(made, self.order, axis=1)
        norms = np.sqrt((lifted * lifted).sum(axis=1))
        self.least, self.most = norms.min(), norms.max()

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors, np.full(len(vectors), self.lift)])

    def ranges(self, made: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each tree's array that share a query's first ``level`` bits."""
        free = np.uint64(BITS - level)
        low = (made >> free) << free
        high = low + ((np.uint64(1) << free) - np.uint64(1))
        return (np.stack([np.searchsorted(s, q, side="left") for s, q in zip(self.sorted, low)]),
                np.stack([np.searchsorted(s, q, side="right") for s, q in zip(self.sorted, high)]))

    def unseen(self, norm: float, distance: float, level: int) -> float:
        """Chance at most that a row within ``distance`` of a query of lifted
        norm ``norm`` shares ``level`` bits with it in no tree."""
        # the widest angle at that distance, over the norms that rows have
        widest = np.clip(np.sqrt(max(norm * norm - distance * distance, 0.0)), self.least, self.most)
        cosine = (norm * norm + widest * widest - distance * distance) / (2 * norm * widest)
        same = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi
        return (1 - same ** level) ** len(self.sorted)

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, miss: float):
        """For each query the positions and distances of its nearest rows."""
        lifted = self.lifted(vectors)
        made = strings(lifted.astype(np.float32), self.normals)
        norms = np.sqrt((lifted * lifted).sum(axis=1))
        trees = range(len(self.sorted))
        at = [np.zeros(0, np.int64)] * len(ids)
        far = [np.zeros(0)] * len(ids)
        met = np.zeros((len(ids), len(self.ids)), bool)      # at most BLOCK_ROWS x SEGMENT_ROWS
        active = np.arange(len(ids))
        inner = outer = None                # the level before: its rows have been measured
        for level in range(BITS, -1, -1):
            if not len(active):
                break
            low, high = self.ranges(made[:, active], level)
            inner, outer = (low, low) if inner is None else (inner, outer)
            going = []
            for c, q in enumerate(active):
                rings = [self.order[t, x:y] for t in trees
                         for x, y in ((low[t, c], inner[t, c]), (outer[t, c], high[t, c])) if y > x]
                if rings:
                    mark = np.zeros(len(self.ids), bool)
                    mark[np.concatenate(rings)] = True
                    new = np.flatnonzero(mark & ~met[q])
                    met[q, new] = True
                    new = new[self.ids[new] != ids[q]]
                    gap = self.vectors[new] - vectors[q]
                    at[q] = np.concatenate([at[q], new])
                    far[q] = np.concatenate([far[q], np.sqrt((gap * gap).sum(axis=1))])
                if len(far[q]) < k or self.unseen(norms[q], np.partition(far[q], k - 1)[k - 1], level) > miss:
                    going.append(c)
            active, inner, outer = active[going], low[:, going], high[:, going]
        return at, far


def search(rows: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10,
           miss: float = MISS, segment_rows: int = SEGMENT_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of every query
    row, score their exact distance."""
    base = stored(usable(rows, vec_id, vector), "ann-rows")
    asked = stored(usable(queries, vec_id, vector), "ann-queries")
    about = base.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("norm", [0.05, 0.95], 1000).alias("p")).first()
    segments = max(1, -(-about["n"] // segment_rows))
    blocks = max(1, -(-asked.count() // block_rows))
    lift = float(about["p"][1] - about["p"][0]) if about["n"] else 0.0
    lift = 0.0 if about["n"] and lift < 1e-4 * about["p"][1] else lift

    def dealt(df, parts, salt):
        return F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(parts)).cast("int")

    held = base.withColumn("segment", dealt(base, segments, 0)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("dim", "segment", "block")
    sought = asked.withColumn("block", dealt(asked, blocks, 1)).withColumn(
        "segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))).groupBy("dim", "segment", "block")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {c: [] for c in ("query_id", "vec_id", "score")}
        if left.num_rows and right.num_rows:
            ids, vectors = _arrays(left)
            forest = Forest(ids, vectors, lift)
            query_ids, query_vectors = _arrays(right)
            for q, at, d in zip(query_ids, *forest.search(query_ids, query_vectors, k, miss)):
                best = np.lexsort((forest.ids[at], d))
                best = best[np.sort(np.unique(forest.ids[at[best]], return_index=True)[1])[:k]]
                found["query_id"].append(np.full(len(best), q))
                found["vec_id"].append(forest.ids[at[best]])
                found["score"].append(d[best])
        return pa.table({c: pa.array(np.concatenate([*v, np.zeros(0)]).astype(np.float64 if c == "score" else np.int64))
                         for c, v in found.items()})

    near = held.cogroup(sought).applyInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = np.concatenate([c.flatten().to_numpy() for c in table.column("v").chunks])
    return ids, flat.reshape(len(ids), -1)
