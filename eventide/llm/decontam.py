"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the positions of every word of every document.  The
index is cut by documents into segments of bounded size, as search clusters
do: a segment holds, for each of its words, the sorted positions as one
posting list.  Nothing is shuffled to build it, and the list of a very common
word is spread over all segments.

``search`` cuts benchmark items into windows of consecutive words.  In each
segment a window's words are taken from the rarest on: their lists, moved back
by the word's offset, are intersected until the list of possible starts is
empty or all words agree.  That gives exact phrases; with ``slop`` a word may
also stand that many places off, which gives proximity matches.  Only posting
lists of words that some item has leave the stored index.  Items are searched
in blocks of bounded size, so the memory a task needs depends on neither the
documents nor the number of items.

Cases: a null text or one without words has no words and matches nothing; an
item without words has no window, one of fewer words than a window is one
window; a window never crosses documents; rows that repeat (documents or
items) count each; items that share an item_id are one id in the results;
empty tables give no rows or no matches; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm._text import NOT_WORD, ascii_lower, fresh, slices, split_words
from eventide.llm.components import stored
from eventide.session import scratch_path

WINDOW = 10                     # words
SEGMENT_WORDS = 2 << 20         # a segment closes once it has as many
BLOCK_WORDS = 500_000           # words of items searched in one pass
GAP = 64                        # free places between documents, over any window and slop
INDEX = ("kind string, segment long, term binary, cf int, postings binary, doc_ord int, doc_id long, text_hash long, "
         "n_words int")


class _Segment:
    """Words of some documents, waiting to be written as posting lists."""

    def __init__(self, number: int):
        self.number, self.terms, self.at, self.docs, self.hashes, self.bases, self.sizes = number, [], [], [], [], [], []
        self.words = self.next = 0

    def add(self, ids: pa.Array, hashes: pa.Array, text: pa.Array) -> None:
        words = split_words(text)
        sizes = np.diff(words.first)
        bases = self.next + np.append(0, np.cumsum(sizes + GAP)[:-1])
        self.terms.append(words.arrow())
        self.at.append((np.repeat(bases - words.first[:-1], sizes) + np.arange(words.first[-1])).astype(np.int32))
        self.docs.append(ids)
        self.hashes.append(hashes)
        self.bases.append(bases.astype(np.int32))
        self.sizes.append(sizes.astype(np.int32))
        self.words += int(words.first[-1])
        self.next += int((sizes + GAP).sum())

    def batches(self):
        """Rows of the index: documents, the places where they begin (the
        list of the empty term, which no word is), and one list a term."""
        n, number = sum(map(len, self.docs)), self.number
        yield _rows(n, kind="doc", segment=number, doc_ord=np.arange(n, dtype=np.int32),
                    doc_id=pa.chunked_array(self.docs).combine_chunks(),
                    text_hash=pa.chunked_array(self.hashes).combine_chunks(), n_words=np.concatenate(self.sizes))
        bases = np.concatenate(self.bases).astype("<i4")
        yield _rows(1, kind="term", segment=number, term=pa.array([b""], pa.binary()), cf=np.array([n], np.int32),
                    postings=pa.array([bases.tobytes()], pa.binary()))
        coded = pa.chunked_array(self.terms, pa.large_binary()).combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        at = np.concatenate(self.at).astype("<i4")[order]
        cf = np.bincount(codes, minlength=len(coded.dictionary)).astype(np.int32)
        ends = (4 * np.append(0, np.cumsum(cf))).astype(np.int32)
        terms = coded.dictionary.cast(pa.binary())
        lists = pa.Array.from_buffers(pa.binary(), len(cf), [None, pa.py_buffer(ends), pa.py_buffer(at)])
        for k in range(0, len(cf), 20_000):
            part = slice(k, k + 20_000)
            yield _rows(len(cf[part]), kind="term", segment=number, term=terms[part], cf=cf[part], postings=lists[part])


def _rows(n: int, **columns) -> pa.RecordBatch:
    kinds = {"kind": pa.string(), "segment": pa.int64(), "term": pa.binary(), "cf": pa.int32(), "postings": pa.binary(),
             "doc_ord": pa.int32(), "doc_id": pa.int64(), "text_hash": pa.int64(), "n_words": pa.int32()}
    cols = []
    for name, kind in kinds.items():
        v = columns.get(name)
        if v is None:
            v = pa.nulls(n, kind)
        elif isinstance(v, (str, int)):
            v = pa.repeat(pa.scalar(v, kind), n)
        cols.append(v if isinstance(v, pa.Array) else pa.array(v, kind))
    return pa.RecordBatch.from_arrays(cols, names=list(kinds))


def row_hash(text: str):
    """Hash of a text, null as the empty one."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index of ``docs``, a table in the shared checkpoint folder
    with rows of kind ``doc`` (segment, doc_ord, doc_id, text_hash, n_words) and ``term``
    (segment, term, cf, postings: positions as little-endian int32)."""
    spark = docs.sparkSession

    def run(batches):
        from pyspark import TaskContext

        task, made, segment = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for part in slices(batch, "text", min(4 << 20, 4 * segment_words)):
                if segment is None:
                    segment = _Segment((task << 32) + made)
                segment.add(part.column("doc_id"), part.column("text_hash"), part.column("text"))
                if segment.words + GAP * sum(map(len, segment.docs)) >= segment_words:
                    yield from segment.batches()
                    segment, made = None, made + 1
        if segment is not None:
            yield from segment.batches()

    path = scratch_path(spark, "llm-position-index")
    (docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(text).alias("text_hash"), F.col(text).alias("text"))
     .mapInArrow(run, INDEX)
     .write.partitionBy("kind").option("compression", "zstd").parquet(path))
    return spark.read.schema(INDEX).parquet(path)


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``(item_id, words)``: every window of ``size`` consecutive words."""
    words = F.filter(F.split(ascii_lower(F.col(text)), NOT_WORD), lambda w: w != "")
    begins = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (items.select(F.col(item_id).alias("item_id"), words.alias("words")).where(F.size("words") > 0)
            .select("item_id", F.explode(F.transform(begins, lambda k: F.slice("words", k, size))).alias("words")))


def starts_of(window: np.ndarray, cf: np.ndarray, lists, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Starts in a segment where a window stands exactly, and starts where its
    first word stands and every other is within ``slop`` of its place (the
    former among them).  ``window`` has term numbers, ``lists(term)`` their
    sorted positions."""
    order = np.argsort(cf[window], kind="stable")
    exact = lists(window[order[0]]) - int(order[0])
    near = exact if order[0] == 0 or not slop else np.unique(exact[:, None] + np.arange(-slop, slop + 1))
    for k in order[1:]:
        if not len(near):
            break
        found = lists(window[k]) - int(k)
        exact = exact[_member(found, exact)]
        near = exact if not slop else near[_member(found, near) if k == 0 else _within(found, near, slop)]
    return exact, near


def _member(sorted_list: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_list, wanted), len(sorted_list) - 1)
    return sorted_list[at] == wanted


def _within(sorted_list: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    at = np.searchsorted(sorted_list, wanted - slop)
    return (at < len(sorted_list)) & (sorted_list[np.minimum(at, len(sorted_list) - 1)] <= wanted + slop)


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text",
           size: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Matches ``(segment, doc_ord, item_id, kind, start, end)``: maximal runs
    of document words (``end`` exclusive) inside windows of the item, kind
    ``phrase``; with ``slop`` also kind ``near``, runs that begin with a
    window's first word and have all others at most ``slop`` off."""
    if size + slop >= GAP:
        raise ValueError(f"window and slop must be under {GAP} words together")
    spark = index.sparkSession
    wins = stored(windows(items, item_id, text, size).distinct(), "item-windows")
    id_type = dict(wins.dtypes)["item_id"]
    total = wins.count() * size
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))
    found = None
    for b in range(blocks):
        part = wins.where(block == b)
        taken = part.select(F.col("item_id").cast("string"), "words").collect()   # at most about block_words words
        if taken or found is None:
            hits = _search_block(spark, index, taken, slop)
            found = hits if found is None else found.union(hits)
    # windows of one item that overlap or touch become one run
    own = Window.partitionBy("segment", "doc_ord", "item_id", "kind").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(own))
    return (runs.groupBy("segment", "doc_ord", "item_id", "kind", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")
            .withColumn("item_id", F.col("item_id").cast(id_type)))


def _search_block(spark, index: DataFrame, taken, slop: int) -> DataFrame:
    vocabulary = sorted({w for r in taken for w in r["words"]})
    number = {w: k for k, w in enumerate(vocabulary)}
    wanted = [(r["item_id"], np.array([number[w] for w in r["words"]], np.int32)) for r in taken]
    terms = spark.createDataFrame([(bytearray(w.encode()), k) for w, k in number.items()] + [(bytearray(), -1)],
                                  "term binary, number int")
    lists = (index.where("kind = 'term'").join(F.broadcast(terms), "term")    # at most block_words terms
             .select("segment", "number", "postings"))

    def run(table: pa.Table) -> pa.Table:
        numbers = table.column("number").to_numpy()
        raw = table.column("postings").combine_chunks()
        held = {int(n): np.frombuffer(raw[k].as_py(), "<i4") for k, n in enumerate(numbers)}
        bases = held.pop(-1)
        cf = np.zeros(len(vocabulary), np.int64)
        for n, positions in held.items():
            cf[n] = len(positions)
        out = {c: [] for c in ("doc_ord", "item_id", "kind", "start", "end")}
        for item, window in wanted:
            if cf[window].min() == 0:
                continue
            exact, near = starts_of(window, cf, held.__getitem__, slop)
            for kind, places in (("phrase", exact), ("near", near if slop else exact[:0])):
                if len(places):
                    doc = np.searchsorted(bases, places, side="right") - 1
                    start = places - bases[doc]
                    out["doc_ord"].append(doc)
                    out["start"].append(start)
                    out["end"].append(start + len(window))
                    out["item_id"] += [item] * len(places)
                    out["kind"] += [kind] * len(places)
        n = len(out["item_id"])
        ints = {c: pa.array(np.concatenate([*out[c], np.zeros(0)]).astype(np.int32)) for c in ("doc_ord", "start", "end")}
        segment = table.column("segment")[0].as_py()
        return pa.table({"segment": pa.repeat(pa.scalar(segment, pa.int64()), n), "doc_ord": ints["doc_ord"],
                         "item_id": pa.array(out["item_id"], pa.string()), "kind": pa.array(out["kind"], pa.string()),
                         "start": ints["start"], "end": ints["end"]})

    return lists.groupBy("segment").applyInArrow(
        run, "segment long, doc_ord int, item_id string, kind string, start int, end int")


def report(index: DataFrame, matches: DataFrame) -> DataFrame:
    """One row for each indexed document row: ``(doc_id, text_hash, n_words, n_hit, items)``;
    n_hit counts the words inside phrase matches, items are the distinct
    item_ids, sorted as strings."""
    phrase = matches.where("kind = 'phrase'")
    by_place = Window.partitionBy("segment", "doc_ord").orderBy("start", "end")
    before = F.coalesce(F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", before))
    hit = phrase.select("segment", "doc_ord", "item_id", new.alias("new")).groupBy("segment", "doc_ord").agg(
        F.sum("new").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    docs = index.where("kind = 'doc'").select("segment", "doc_ord", "doc_id", "text_hash", "n_words")
    return docs.join(hit, ["segment", "doc_ord"], "left").select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows in which a window of an item
    stands."""
    index = build_index(docs, doc_id, text)
    bad_id, bad_hash = fresh(docs.columns, "__id", "__hash")
    bad = stored(report(index, search(index, items)).where("n_hit > 0").select(
        F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct(), "contaminated")
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col(bad_id)) & (row_hash(text) == F.col(bad_hash)), "left_anti")
