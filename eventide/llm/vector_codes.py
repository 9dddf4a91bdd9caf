"""Vector codes: every quarter of a vector becomes the number of its nearest
codebook entry, learned by whole-number k-means over all rows.

Rows are cut into parts, and each part's rows are put in the order of a
Hilbert curve, so rows that follow one another lie close together.  The order
is cut into flat blocks that are stored with the smallest and largest value of
every component (a box) and the sums of all.  In each round the least and the
greatest distance from a block's box to each entry say which entries can be
nearest to any of its rows: those whose least distance is no more than the
smallest greatest one.  Where one entry is left, the stored sums are the
block's share of it and no row is looked at; else distances are worked out,
exactly and in whole numbers, to the shortlist alone.

Cases: vectors that are null or hold null or non-finite components take no
part, neither do those of another length than most vectors have; components
times 1024 are held within 2^24; a table of fewer rows than entries has as many entries
as rows; equal vec_ids start the codebook in the order of their vectors, null
ones last; rows that repeat return repeated; a component count that 4 does not
divide is cut at ``dim * part // 4``; an empty table gives no rows and an
empty codebook; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import hot
from eventide.llm.components import stored
from eventide.llm.vectors import commonest_size, finite, floors

PARTS = 4
ENTRIES = 256
ROUNDS = 4
FACTOR = 1024
BLOCK_ROWS = 512
KEY_BITS = 62               # of a Hilbert key; a part of more dimensions is ordered by 62 of them
EXACT = float(1 << 53)      # whole numbers below are exact as doubles


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of the rows of ``cells`` (numbers below ``2 ** bits``) along the
    Hilbert curve through all cells of their grid."""
    x = cells.T.astype(np.int64)
    dims = len(x)
    # from the top bit down: a set bit mirrors the low bits of the first axis, a clear one swaps them with it
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in range(dims):
            is_set = (x[axis] >> bit) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[axis] ^= swap
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = (key << 1) | ((x[axis] >> bit) & 1)
    return key


def part_bounds(dim: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dim)


def part_keys(x: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Hilbert keys of rows, on a grid over two deviations to both sides."""
    dims = np.unique(np.linspace(0, x.shape[1] - 1, min(x.shape[1], KEY_BITS)).astype(int)) if x.shape[1] else []
    if not len(dims):
        return np.zeros(len(x), np.int64)
    bits = max(1, KEY_BITS // len(dims))
    at = (x[:, dims] - (middle - 2 * spread)[dims]) / np.maximum(4 * spread[dims], 1e-9)
    return hilbert_keys(np.clip(np.floor(at * (1 << bits)), 0, (1 << bits) - 1), bits)


_CUT = "part int, place long, row long, x array<long>"


def _cut_rows(bounds, middle, spread):
    def cut(batches):
        for batch in batches:
            x = matrix(batch.column("x"), bounds[-1][1])
            for p, (a, b) in enumerate(bounds):
                piece = np.ascontiguousarray(x[:, a:b])
                values = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * (b - a), piece.ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), p, np.int32)), pa.array(part_keys(piece, middle[a:b], spread[a:b])),
                     batch.column("row"), values], ["part", "place", "row", "x"])
    return cut


_BLOCK = "part int, rows binary, x binary, low binary, high binary, sums binary"


def _pack_blocks(bounds, block_rows):
    """Sorted rows of a partition into blocks of one part each."""
    def block(part, rows, x):
        return {"part": part, "rows": rows.tobytes(), "x": x.astype(np.int64).tobytes(), "low": x.min(0).tobytes(),
                "high": x.max(0).tobytes(), "sums": x.sum(0).tobytes()}

    schema = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("rows", "x", "low", "high", "sums")]])

    def pack(batches):
        part, rows, xs, held = None, [], [], 0

        def flush():
            return block(part, np.concatenate(rows), np.concatenate(xs))

        for batch in batches:
            parts = batch.column("part").to_numpy()
            ids, out = batch.column("row").to_numpy(), []
            at = 0
            while at < len(parts):
                if part is not None and (parts[at] != part or held == block_rows):
                    out.append(flush())
                    rows, xs, held = [], [], 0
                part = int(parts[at])
                to = min(at + block_rows - held, int(np.searchsorted(parts, part, side="right")))
                a, b = bounds[part]
                rows.append(ids[at:to])
                xs.append(matrix(batch.column("x").slice(at, to - at), b - a))
                held, at = held + to - at, to
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist([flush()], schema=schema)
    return pack


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Numbers of the entries that can be nearest to a point of the box."""
    outside = np.maximum(np.maximum(low - book, book - high), 0)
    furthest = np.maximum(np.abs(book - low), np.abs(book - high))
    return np.flatnonzero((outside * outside).sum(1) <= (furthest * furthest).sum(1).min())


def nearest(x: np.ndarray, book: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest of the entries ``among`` (ties: the first) and
    its squared distance, exactly."""
    few = book[among]
    reach = max(int(np.abs(x).max(initial=0)), int(np.abs(few).max(initial=0)))
    if 4 * reach * reach * max(x.shape[1], 1) < EXACT:      # all terms are exact as doubles
        a, e = x.astype(np.float64), few.astype(np.float64)
        d = ((a * a).sum(1)[:, None] - 2 * (a @ e.T) + (e * e).sum(1)).astype(np.int64)
    else:
        d = np.stack([((x - one) ** 2).sum(1) for one in few], axis=1)
    best = d.argmin(1)
    return among[best], d[np.arange(len(x)), best]


def _blocks(batch: pa.RecordBatch, bounds):
    """``(part, low, high, sums, x, rows)`` of stored blocks, each of the last
    two a function that reads it."""
    names = batch.schema.names
    for k in range(batch.num_rows):
        def of(name, k=k):
            return np.frombuffer(batch.column(name)[k].as_buffer(), dtype=np.int64)
        part = batch.column("part")[k].as_py()
        a, b = bounds[part]
        n = len(batch.column("x")[k].as_buffer()) // 8 // (b - a) if b > a else len(batch.column("rows")[k].as_buffer()) // 8
        yield part, n, of("low"), of("high"), of("sums"), of("x").reshape(n, b - a), of("rows") if "rows" in names else None


def _round_sums(bounds, books):
    """A round's share of one task: rows and sums of every entry met."""
    def sums(batches):
        total = [np.zeros((len(book), b - a + 1), np.int64) for book, (a, b) in zip(books, bounds)]
        for batch in batches:
            for part, n, low, high, whole, x, _ in _blocks(batch, bounds):
                among, mine = shortlist(low, high, books[part]), total[part]
                if len(among) == 1:
                    mine[among[0], 0] += n
                    mine[among[0], 1:] += whole
                    continue
                entry, _ = nearest(x, books[part], among)
                np.add.at(mine[:, 0], entry, 1)
                np.add.at(mine[:, 1:], entry, x)
        for part, mine in enumerate(total):
            entry = np.flatnonzero(mine[:, 0])
            width = mine.shape[1]
            if len(entry):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(entry) * width, part, np.int32)), pa.array(np.repeat(entry, width).astype(np.int32)),
                     pa.array(np.tile(np.arange(width, dtype=np.int32), len(entry))), pa.array(mine[entry].ravel())],
                    ["part", "entry", "place", "total"])
    return sums


def _codes(bounds, books):
    def codes(batches):
        for batch in batches:
            for part, n, low, high, _, x, rows in _blocks(batch, bounds):
                entry, error = nearest(x, books[part], shortlist(low, high, books[part]))
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.full(n, part, np.int32)),
                                                  pa.array(entry.astype(np.int32)), pa.array(error)], ["row", "part", "entry", "error"])
    return codes


@dataclass
class Codebook:
    """Entries of every part: whole numbers, ``(entries, components)``."""
    books: list[np.ndarray]

    def sha256(self) -> str:
        said = ",".join(str(int(c)) for book in self.books for c in np.asarray(book).ravel())
        return hashlib.sha256(said.encode()).hexdigest()


def first_entries(kept: DataFrame, entries: int, bounds) -> list[np.ndarray]:
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    x = np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), bounds[-1][1])
    return [np.ascontiguousarray(x[:, a:b]) for a, b in bounds]


def build_blocks(kept: DataFrame, bounds, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The stored blocks of ``kept(row, x)``."""
    stats = {r["at"]: r for r in kept.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.avg("c").alias("middle"), F.stddev_pop("c").alias("spread")).collect()}
    middle, spread = (np.array([stats[k][s] for k in range(bounds[-1][1])] if stats else [0.0] * bounds[-1][1]) for s in ("middle", "spread"))
    cut = kept.select("row", "x").mapInArrow(_cut_rows(bounds, middle, spread), _CUT)
    # equal keys are told apart by the row, so a hot vector is dealt to many tasks
    ordered = cut.repartitionByRange("part", "place", F.xxhash64("row")).sortWithinPartitions("part", "place")
    return stored(ordered.mapInArrow(_pack_blocks(bounds, block_rows), _BLOCK), "code-blocks")


def learn(blocks: DataFrame, books: list[np.ndarray], bounds, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Rounds of k-means.  What comes to the driver is one number for each
    component of an entry, whatever the number of rows."""
    for _ in range(rounds):
        got = blocks.select("part", "x", "low", "high", "sums").mapInArrow(
            _round_sums(bounds, books), "part int, entry int, place int, total long")
        total = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in books]
        for r in got.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
            total[r["part"]][r["entry"], r["place"]] = r["total"]
        books = [np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), book) for t, book in zip(total, books)]
    return books


def encode(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
           entries: int = ENTRIES, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, Codebook]:
    """``(vec_id, label, entries, code, error)``, one row for each vector that
    takes part, and the codebook.  ``code`` has two hex digits for each part
    (more if there are more than 256 entries)."""
    usable = rows.where(finite(vector))
    dim = commonest_size(usable, vector)
    kept = stored(usable.where(F.size(f"`{vector}`") == dim).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{vec_id}`").alias("vec_id"),
        F.col(f"`{label}`").alias("label"), floors(vector, FACTOR).alias("x")), "code-rows")
    bounds = part_bounds(dim, parts)
    books = first_entries(kept, entries, bounds)
    blocks = build_blocks(kept, bounds, block_rows)
    books = learn(blocks, books, bounds, rounds)
    met = blocks.mapInArrow(_codes(bounds, books), "row long, part int, entry int, error long")
    by_row = met.groupBy("row").agg(*[F.max(F.when(F.col("part") == p, F.col("entry"))).alias(f"e{p}") for p in range(parts)],
                                    F.sum("error").alias("error"))
    width = max(2, len(f"{max(entries - 1, 0):x}"))
    chosen = [F.col(f"e{p}") for p in range(parts)]
    code = F.concat(*[F.lpad(F.lower(F.hex(c)), width, "0") for c in chosen])
    return kept.select("row", "vec_id", "label").join(by_row, "row").select(
        "vec_id", "label", F.array(*chosen).alias("entries"), code.alias("code"), "error"), Codebook(books)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``, the sum of ``error`` over rows of an equal label
    (nulls together); null if it has more than 63 bits."""
    codes = stored(codes, "codes")
    by_label = stored(codes.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("error").cast("decimal(38,0)")).alias("sum")), "code-labels")
    total = by_label.agg(F.sum("n")).first()[0] or 0
    found = hot.attach(codes, by_label, ["label"], "n", total, F.col("code"))
    return found.withColumn("label_error", F.col("sum").try_cast("long")).drop("n", "sum")
