"""WARC archives: a writer that stores equal payloads once, and a reader that
salvages damaged files.

Writing: payloads are grouped by their SHA-1; of the rows with an equal
payload (of at least ``least`` bytes) that with the largest id is written as a
``response``, the others as ``revisit`` records that refer to it.  A record is
an HTTP message; a revisit keeps the message's header, so the full payload's
length and digest can be read from it.  Files are written by Spark's own text
writer, whose commit protocol keeps out what a lost executor left.  In
compressed files every record is a gzip member by itself, and members are
parted by an empty member (the writer's line separator).

Reading: a file is read from its start, one record after another.  A record is
good if its gzip member is whole (length and CRC), its version line, header
and ``Content-Length`` are well formed, two line ends follow the block, and
the block's and the payload's digests hold.  After a failed check the reader
searches for the next gzip member or version line at which a good record
starts, goes on there, and logs the bytes between as a gap with the reason.
Records, gaps and empty members together cover every byte of a file.

Cases: a null payload is empty; rows that share the largest id of their
payload (a null id is the smallest) are all responses, under one record id; null ids and addresses
have no header line; bytes of ids and addresses that would break a line are
percent-encoded; rows that repeat return repeated; an empty table writes
files without records; further columns are ignored.  A file is read by one
task, so its size bounds the task's memory: the writer ends a file at about
``ARCHIVE_BYTES`` of payload.  A payload that itself holds a record can give
that record where the outer one is damaged.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote_from_bytes, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import hot
from eventide.llm.components import stored

ARCHIVE_BYTES = 32 << 20        # of payload, that a file holds about
LINES_BYTES = 4 << 20           # of records that a task hands on in one go
VERSION = b"WARC/1.1"
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)
_MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")
_CONTROL = re.compile(rb"[\x00-\x08\x0a-\x1f\x7f]")
_STEP = 1 << 16                 # compressed bytes looked at in one go
_UNSAFE = bytes(b for b in range(33, 127) if b != 37)


def digest(data: bytes) -> str:
    """Base32 SHA-1, as WARC headers carry it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- writing

def _line_safe(value) -> bytes:
    """A header value in one line of printable characters."""
    return quote_from_bytes(str(value).encode(), safe=_UNSAFE).encode()


def record(kind: str, record_id: str, date: str, payload: bytes, page_id=None, url=None, refers_to=None,
           refers_to_id: str | None = None) -> bytes:
    """The bytes of one record.  A revisit carries the header of the message
    whose payload is ``payload``, not the payload."""
    message = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = message + (payload if kind == "response" else b"")
    head = [(b"WARC-Type", kind.encode()), (b"WARC-Record-ID", f"<{record_id}>".encode()), (b"WARC-Date", date.encode()),
            (b"Content-Type", b"application/http; msgtype=response"), (b"Content-Length", b"%d" % len(block)),
            (b"WARC-Block-Digest", b"sha1:" + digest(block).encode()), (b"WARC-Payload-Digest", b"sha1:" + digest(payload).encode())]
    if url is not None:
        head.append((b"WARC-Target-URI", _line_safe(url)))
    if page_id is not None:
        head.append((b"Page-ID", _line_safe(page_id)))
    if kind == "revisit":
        head += [(b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 (b"WARC-Refers-To", f"<{refers_to_id}>".encode())]
        if refers_to is not None:
            head.append((b"Refers-To-Page-ID", _line_safe(refers_to)))
    return VERSION + b"\r\n" + b"".join(b"%s: %s\r\n" % h for h in head) + b"\r\n" + block + b"\r\n\r\n"


def _records(date: str, compressed: bool):
    """Rows ``(page_id, url, payload, kind, refers_to, group_id, own_id)`` to lines."""
    def write(batches):
        lines, held = [], 0
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "payload", "kind", "refers_to", "group_id", "own_id")]
            for k in range(batch.num_rows):
                page, url, payload, kind, refers_to, group_id, own_id = (c[k].as_py() for c in cols)
                one = record(kind, f"urn:uuid:{own_id}", date, payload or b"", page, url, refers_to, f"urn:uuid:{group_id}")
                # the text writer adds the separator: an empty member, or the last line end
                one = gzip.compress(one, 6, mtime=0) if compressed else one[:-1]
                lines.append(one)
                held += len(one)
                if held > LINES_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["line"])
                    lines, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["line"])
    return write


def _as_uuid(hex32):
    return F.concat_ws("-", *[F.substring(hex32, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def decide(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> tuple[DataFrame, float]:
    """``(page_id, url, payload, kind, refers_to, group_id, own_id)`` of every
    row, and the mean payload's bytes.  Payloads themselves are shuffled only
    where the table of repeated ones is too large to be broadcast."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), body.alias("payload"),
                        F.sha1(body).alias("sha1"), F.octet_length(body).alias("bytes"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("bytes").alias("mean")).first()
    repeated = stored(rows.where(F.col("bytes") >= least).groupBy("sha1").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_id").alias("head")).where("n > 1"), "warc-repeated")
    met = hot.attach(rows, repeated, ["sha1"], "n", total["n"], F.struct("page_id", "url"))
    first = F.col("n").isNull() | F.col("page_id").eqNullSafe(F.col("head"))
    group_id = F.md5(F.concat(F.lit("response "), "sha1"))
    own_id = F.when(F.col("n").isNotNull() & first & F.col("page_id").isNotNull(), group_id).otherwise(
        F.md5(F.concat(F.col("sha1"), F.lit(" "), F.monotonically_increasing_id().cast("string"))))
    return met.select(
        "page_id", "url", "payload", F.when(first, "response").otherwise("revisit").alias("kind"),
        F.when(~first, F.col("head")).alias("refers_to"), _as_uuid(group_id).alias("group_id"), _as_uuid(own_id).alias("own_id"),
    ), total["mean"] or 0.0


def write_archives(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", compressed: bool = True,
                   archive_bytes: int = ARCHIVE_BYTES, **columns) -> None:
    """Write a record for every row below ``path`` (it must be new); ``date``
    is the time of capture of all of them.  ``columns``: as in :func:`decide`."""
    decided, mean = decide(pages, **columns)
    lines = decided.mapInArrow(_records(date, compressed), "line binary").select(F.col("line").cast("string").alias("value"))
    out = lines.write.option("maxRecordsPerFile", max(1, int(archive_bytes / max(mean, 512))))
    if compressed:      # bytes as they are: one character of this encoding is one byte
        out = out.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER.decode("latin-1"))
    out.text(path)


# ---------------------------------------------------------------- reading

class Found(NamedTuple):
    """A record, or with ``reason`` a gap, at ``offset`` of a file."""
    offset: int
    length: int
    reason: str | None
    head: dict[str, str]
    payload: bytes


class Damaged(Exception):
    """A failed check; ``end`` is where the record ends if its frame is whole."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``."""
    unzip, out = zlib.decompressobj(wbits=31), []
    try:
        while not unzip.eof and at < len(data):
            out.append(unzip.decompress(data[at:at + _STEP]))
            at += min(_STEP, len(data) - at) - len(unzip.unused_data)
    except zlib.error:
        raise Damaged("gzip member is corrupt") from None
    if not unzip.eof:
        raise Damaged("gzip member is cut short")
    return b"".join(out), at


def _checked(head: dict[str, str], name: str, data: bytes, end: int) -> None:
    said = head.get(name, "")
    if said.lower().startswith("sha1:") and said[5:].upper() != digest(data):
        raise Damaged(f"{name} does not hold", end)


def _record(data, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header, payload and end of the uncompressed record at ``at``."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    head, at = {}, version.end()
    while True:
        stop = data.find(b"\r\n", at, at + _STEP)
        if stop < 0:
            raise Damaged("header has no end")
        line, at = bytes(data[at:stop]), stop + 2
        if not line:
            break
        name, colon, value = line.partition(b":")
        name = name.strip().decode("latin-1").lower()
        if not colon or not name or _CONTROL.search(line):
            raise Damaged("header line is malformed")
        if name in head and name != "warc-concurrent-to":
            raise Damaged("header line repeats")
        head[name] = value.strip().decode("utf-8", "replace")
    size = head.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", size):
        raise Damaged("no Content-Length")
    end = at + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("no line ends after the block")
    block, end = bytes(data[at:end]), end + 4
    _checked(head, "warc-block-digest", block, end)
    http, parted, payload = block.partition(b"\r\n\r\n")
    if not (parted and head.get("content-type", "").startswith("application/http")):
        http, payload = b"", block
    told = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", http)
    if head.get("warc-type") == "revisit":
        head["payload bytes"] = told[1].decode() if told else None
    else:
        _checked(head, "warc-payload-digest", payload, end)
        head["payload bytes"] = str(len(payload))
    return head, payload, end


def salvage(data: bytes) -> Iterator[Found]:
    """Records and gaps of a file, in order.  Empty members are passed over."""
    view, at, gap, why = memoryview(data), 0, None, ""
    while at < len(data):
        try:
            if data.startswith(_MAGIC, at):
                content, end = _member(view, at)
                got = None
                if content:
                    try:
                        got = _record(content, 0)
                    except Damaged as e:        # the member is whole: the next one follows it
                        raise Damaged(str(e), end) from None
                    if got[2] != len(content):
                        raise Damaged("member holds more than a record", end)
            else:
                got = _record(data, at)
                end = got[2]
        except Damaged as e:
            if gap is None:
                gap, why = at, str(e)
            # a whole frame is passed only if it leads to the end or to another start
            if e.end is not None and (e.end == len(data) or _NEXT.match(data, e.end)):
                at = e.end
                continue
            following = _NEXT.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield Found(gap, at - gap, why, {}, b"")
            gap = None
        if got is not None:
            yield Found(at, end - at, None, got[0], got[1])
        at = end
    if gap is not None:
        yield Found(gap, len(data) - gap, why, {}, b"")


_READ = ("path string, offset long, length long, reason string, record_type string, record_id string, url string, page_id string, "
         "payload_bytes long, payload_digest string, refers_to string")


def _read(with_payload: bool):
    def read(batches):
        for batch in batches:
            paths, contents = batch.column("path"), batch.column("content")
            for k in range(batch.num_rows):
                path, rows = paths[k].as_py(), []
                for f in salvage(contents[k].as_py()):
                    h = f.head
                    kept = h.get("payload bytes")
                    row = {"path": path, "offset": f.offset, "length": f.length, "reason": f.reason,
                           "record_type": h.get("warc-type"), "record_id": h.get("warc-record-id", "").strip("<>") or None,
                           "url": unquote(h["warc-target-uri"]) if "warc-target-uri" in h else None,
                           "page_id": unquote(h["page-id"]) if "page-id" in h else None,
                           "payload_bytes": int(kept) if kept is not None else None,
                           "payload_digest": h["warc-payload-digest"][5:].upper() if h.get("warc-payload-digest", "").lower().startswith("sha1:") else None,
                           "refers_to": unquote(h["refers-to-page-id"]) if "refers-to-page-id" in h else None}
                    if with_payload:
                        row["payload"] = f.payload if f.reason is None else None
                    rows.append(row)
                    if len(rows) == 1000 or with_payload:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in (_READ + (", payload binary" if with_payload else "")).split(", "))])
    return read


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row for each record and, with ``reason``, for each gap of all files
    below ``path``; with ``payload`` the records' payloads."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read(payload), _READ + (", payload binary" if payload else ""))
