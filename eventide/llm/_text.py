"""Byte-level word splitting shared by the Arrow-batched operators.

A word is a maximal run of word bytes.  Both word rules used here put every
byte of a multi-byte character on the same side, so splitting UTF-8 bytes
equals splitting characters.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The word pattern of the contracts, for Java and DuckDB regular expressions.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWER = np.frombuffer(ASCII_LOWER, dtype=np.uint8)
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in _LOWER])


def fresh(columns: list[str], *names: str) -> list[str]:
    """These names, with underscores after those that a column has already
    (in any case of letters)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Words(NamedTuple):
    """Lower-cased words of a batch of texts, end to end."""

    data: np.ndarray     # bytes of all words, without separators
    offsets: np.ndarray  # word i is data[offsets[i]:offsets[i + 1]]
    first: np.ndarray    # text j has words first[j] to first[j + 1] - 1

    def arrow(self) -> pa.Array:
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.offsets) - 1,
            [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 bounds of its texts; null
    is the empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)
    bounds = bounds[column.offset:column.offset + len(column) + 1]
    if not len(column) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def split_words(column: pa.Array) -> Words:
    """Words of every text by the contracts' pattern, A-Z lower-cased."""
    data, bounds = text_bytes(column)
    inside = _IS_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = bounds[:-1]
    cut = cut[cut < len(data)]
    starts[cut] = inside[cut]          # a text's first byte continues no word
    at = np.flatnonzero(starts)
    kept = _LOWER[data[inside]]
    # word bytes up to each word start = offset of the word among kept bytes
    before = np.flatnonzero(starts[inside])
    offsets = np.append(before, len(kept)).astype(np.int64)
    first = np.searchsorted(at, bounds).astype(np.int64)
    return Words(kept, offsets, first)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Cut a batch into row ranges of about ``most`` text bytes each, so work
    arrays stay small; a longer text is a range by itself."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def ascii_lower(col):
    """A-Z to lower case as a Spark expression; other letters stay."""
    from pyspark.sql import functions as F
    return F.translate(col, UPPER, LOWER)
