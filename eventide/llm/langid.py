"""Language ID by a byte convolutional network.

A text is cut into fixed-length byte windows.  Bytes are embedded, filters of
several widths slide over them, each filter keeps its largest response in the
window (max pooling), and a softmax over the pooled responses gives the
window's posterior.  A text's posterior is the mean of its windows', weighted
by their bytes, so every byte of a long text counts.  The network is trained
in numpy on the driver from a bounded sample of labelled rows and applied in
Arrow batches on the executors.

Cases: a null text or one without a letter is ``und`` with score 0, as is
every text when no label can be learned; ties go to the alphabetically first
language; rows repeat as they come; rows without doc_id are never learned
from; an empty table gives no rows.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm._text import fresh, text_bytes

WINDOW = 256            # bytes
WIDTHS = (2, 3, 4)      # bytes seen by a filter
FILTERS = 16            # of each width
EMBED = 8
SAMPLE_ROWS = 6000      # bound on training rows, shared evenly by languages
SAMPLE_CHARS = (256, 256, 64, 20)   # bytes learned of each window drawn: short texts are learned too
UNDETERMINED = "und"


class ByteNet(NamedTuple):
    labels: list[str]
    embed: np.ndarray    # (256, EMBED); byte 0 is padding and embeds to zero
    kernel: np.ndarray   # (widest * EMBED, filters)
    bias: np.ndarray
    out: np.ndarray      # (filters, labels)
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray):
        """Largest responses (rows, filters) and their places."""
        rows, length = windows.shape
        widest = self.kernel.shape[0] // EMBED
        x = np.zeros((rows, (length + widest - 1) * EMBED), np.float32)
        x[:, :length * EMBED] = self.embed[windows].reshape(rows, -1)
        view = np.lib.stride_tricks.sliding_window_view(x, widest * EMBED, axis=1)[:, ::EMBED]
        return (np.ascontiguousarray(view).reshape(rows * length, -1) @ self.kernel).reshape(rows, length, -1)

    def posteriors(self, windows: np.ndarray) -> np.ndarray:
        found = np.empty((len(windows), len(self.labels)), np.float32)
        for at in range(0, len(windows), 64):     # blocks whose responses stay in cache
            top = self.pooled(windows[at:at + 64]).max(axis=1) + self.bias
            found[at:at + 64] = softmax(np.maximum(top, 0) @ self.out + self.out_bias)
        return found


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows (zero padded), the text each is from, and its bytes."""
    sizes = np.diff(bounds)
    counts = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = bounds[:-1][text] + nth * WINDOW
    used = np.minimum(WINDOW, bounds[1:][text] - start)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < used[:, None]
    rows = np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint8)
    return rows, text, used


def train(texts: list[bytes], labels: list[str], epochs: int = 4, rate: float = 0.004,
          batch: int = 64, seed: int = 7) -> ByteNet | None:
    """Adam on cross-entropy; languages weigh the same whatever their share
    of the sample.  None if there is nothing to learn from."""
    names = sorted(set(labels))
    if not names:
        return None
    joined = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    x, of, _ = windows_of(joined, bounds)
    y = np.array([names.index(v) for v in labels], dtype=np.int64)[of]
    rng, widest, n = np.random.default_rng(seed), max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.concatenate([np.repeat([k < w * EMBED for k in range(widest * EMBED)], FILTERS).reshape(-1, FILTERS)
                           for w in WIDTHS], axis=1).astype(np.float32)
    net = ByteNet(names, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                  (rng.normal(0, 0.3, (widest * EMBED, n)) * mask).astype(np.float32),
                  np.zeros(n, np.float32), rng.normal(0, 0.1, (n, len(names))).astype(np.float32),
                  np.zeros(len(names), np.float32))
    net.embed[0] = 0
    if not len(x):
        return net
    weight = (len(y) / np.maximum(np.bincount(y, minlength=len(names)), 1) / len(names)).astype(np.float32)
    params = net[1:]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            got = net.pooled(x[rows])
            place = got.argmax(axis=1)                                    # (rows, filters)
            top = np.take_along_axis(got, place[:, None], axis=1)[:, 0] + net.bias
            h = np.maximum(top, 0)
            delta = softmax(h @ net.out + net.out_bias)
            delta[np.arange(len(rows)), y[rows]] -= 1
            delta *= weight[y[rows]][:, None] / len(rows)
            back = (delta @ net.out.T) * (top > 0)                        # only the pooled places learn
            seen = place[:, :, None] + np.arange(widest)                  # (rows, filters, widest)
            taken = np.where(seen < WINDOW, x[rows][np.arange(len(rows))[:, None, None], np.minimum(seen, WINDOW - 1)], 0)
            patch = net.embed[taken].reshape(len(rows), n, -1)
            g_kernel = np.einsum("rf,rfk->kf", back, patch, optimize=True) * mask
            g_embed = np.zeros_like(net.embed)
            spread = (back[:, :, None] * net.kernel.T[None]).reshape(-1, EMBED)
            np.add.at(g_embed, taken.reshape(-1), spread)
            g_embed[0] = 0
            grads = (g_embed, g_kernel, back.sum(0), h.T @ delta, delta.sum(0))
            step += 1
            for p, g, a, b in zip(params, grads, first, second):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return net


def pieces_of(data: np.ndarray, bounds: np.ndarray, place: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All windows of whole texts, each in the forms of ``SAMPLE_CHARS`` (the
    first as it stands, the others at a hashed start): their bytes, the text
    each is from, and its turn.  Turns are exponential draws by a hash, longer
    for a text of more windows, so texts weigh alike in the pieces of least
    turn and every window of a text has the same chance."""
    _, text, used = windows_of(data, bounds)
    nth = np.arange(len(text)) - np.searchsorted(text, text)
    first, size, windows = bounds[:-1][text], np.diff(bounds)[text], np.bincount(text, minlength=len(place))[text]
    held, turns = [], []
    for k, most in enumerate(SAMPLE_CHARS):
        h = _mixed(place[text].view(np.uint64) + _mixed(nth.astype(np.uint64) * np.uint64(len(SAMPLE_CHARS)) + np.uint64(k)))
        turns.append(-np.log(((h >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)) * windows)
        shift = (_mixed(h) % np.uint64(WINDOW)).astype(np.int64) if k else 0
        length = np.minimum(most if k else used, size)
        start = first + np.clip(nth * WINDOW + shift, 0, size - length)
        at = start[:, None] + np.arange(WINDOW)
        inside = np.arange(WINDOW) < length[:, None]
        ends = np.append(0, np.cumsum(length)).astype(np.int32)
        held.append(pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(data[at[inside]])]))
    return pa.concat_arrays(held), np.tile(text, len(SAMPLE_CHARS)), np.concatenate(turns)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def training_rows(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[bytes], list[str]]:
    """A bounded sample of ``(doc_id, text, lang)``: about an even share of
    ``rows`` for every language, chosen by a hash of doc_id.  Their whole texts
    are cut into windows, and those of least turn (:func:`pieces_of`), at most
    ``len(SAMPLE_CHARS)`` for each row of the share, are learned from.  More
    languages than ``rows`` are an error."""
    labelled = labelled.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    share = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(rows + 1).collect()}
    if len(share) > rows:
        raise ValueError(f"more than {rows} languages: raise the bound on training rows")
    if not share:
        return [], []
    even = max(1, rows // len(share))
    odds = F.create_map(*[F.lit(v) for k, n in sorted(share.items()) for v in (k, even / n)])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in parts(batch.column("text")):
                data, bounds = text_bytes(part)
                places = batch.column("place").slice(at, len(part)).to_numpy()
                piece, of, turn = pieces_of(data, bounds, places)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(at, len(part)).take(pa.array(of)), pa.array(turn), piece], names=["lang", "turn", "piece"])

    pieces = (labelled.where(draw < odds[F.col("lang")])
              .select("lang", F.xxhash64("doc_id", "text").alias("place"), F.lower("text").alias("text"))
              .mapInArrow(cut, "lang string, turn double, piece binary"))
    # each task keeps only so many of a language before the shuffle
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "piece"))
    taken = pieces.withColumn("rank", rank).where(F.col("rank") <= len(SAMPLE_CHARS) * even).select("lang", "piece").collect()
    taken = sorted((r["lang"], bytes(r["piece"])) for r in taken)
    return [t for _, t in taken], [k for k, _ in taken]


def identify(docs: DataFrame, net: ByteNet | None, text: str = "text", lang: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior; columns of
    these names are replaced."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (lang, score)]
    if net is None:
        return docs.select(*kept, F.lit(UNDETERMINED).alias(lang), F.lit(0.0).alias(score))

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            names, scores = [], []
            for at, part in parts(column):
                data, bounds = text_bytes(part)
                rows, of, used = windows_of(data, bounds)
                total = np.zeros((len(part), len(net.labels)))
                np.add.at(total, of, net.posteriors(rows).astype(np.float64) * used[:, None])
                size = np.maximum(np.diff(bounds), 1)[:, None]
                mean = total / size
                best = mean.argmax(axis=1)
                names += [net.labels[k] for k in best]
                scores.append(mean[np.arange(len(part)), best])
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.clip(np.concatenate(scores or [np.zeros(0)]), 0, 1))],
                names=["lang", "score"])

    guess = F.arrow_udf(predict, "lang string, score double")
    has_letter = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    guessed, letter = fresh(docs.columns, "__guess", "__letter")
    found = docs.select(*kept, guess(F.lower(F.col(f"`{text}`"))).alias(guessed), has_letter.alias(letter))
    return found.select(
        *kept, F.when(F.col(letter), F.col(guessed)["lang"]).otherwise(UNDETERMINED).alias(lang),
        F.when(F.col(letter), F.col(guessed)["score"]).otherwise(0.0).alias(score))


def parts(column: pa.Array, most: int = 1 << 20):
    """Cut a column into pieces of about ``most`` bytes."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield at, column.slice(at, to - at)
        at = to
