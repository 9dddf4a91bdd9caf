import gzip
import os
import random

import pytest

import helpers
from eventide.llm import warc
from eventide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PAGES = [(1, "http://a/\r\nX: y", "p"), (2, None, "p"), (2, "u", "p"), (None, "u", "p"), (3, "u", None), (4, "u", ""), (None, None, None),
         (5, "u", "é" * 50_000), (6, "u%20v", "WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), (7, "u", "q"), (7, "u", "q"),
         (8, "u", "\x1f\x08 nul \x00 byte\r\n\r\n"), (9, "u", "long " * 200_000), (-5, "u", "only")]


def files(path):
    return [open(os.path.join(path, f), "rb").read() for f in sorted(os.listdir(path)) if f.startswith("part-")]


def test_equals_sql(spark, tmp_path):
    assert helpers.same_as_sql(spark, SF, "op12_warc") == 50
    assert helpers.same_as_sql(spark, helpers.write(tmp_path, pages=PAGES), "op12_warc") == len(PAGES)


def test_empty_table(spark, tmp_path):
    assert QUERIES["op12_warc"](spark, helpers.write(tmp_path)).count() == 0


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip_of_payloads_and_addresses(spark, tmp_path, compressed):
    folder, out = helpers.write(tmp_path, pages=PAGES), str(tmp_path / "out")
    pages = spark.read.parquet(f"{folder}/pages.parquet").selectExpr("*", "1 AS payload", "2 AS sha1", "3 AS kind", "4 AS n")
    warc.write_archives(pages, out, compressed=compressed, archive_bytes=2000)
    got = warc.read_archives(spark, out, payload=True).collect()
    assert all(r["reason"] is None for r in got) and len(files(out)) > 1
    assert sorted(str((r["page_id"] and int(r["page_id"]), r["url"])) for r in got) == sorted(str((p, u)) for p, u, _ in PAGES)
    full = {str(r["page_id"]): bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    assert all(full[str(p)] == (h or "") for p, _, h in PAGES if p in (2, 4, 5, 6, 7, 8, 9, -5))
    revisits = [r for r in got if r["record_type"] == "revisit"]
    heads = {r["record_id"] for r in got if r["record_type"] == "response"}
    assert sorted(str(r["page_id"]) for r in revisits) == ["1", "3", "None", "None"] and {r["refers_to"] for r in revisits} == {"2", "4"}
    assert len({r["record_id"] for r in revisits}) == 4 and heads
    # least payload of a revisit
    small = str(tmp_path / "small")
    warc.write_archives(pages, small, compressed=compressed, least=1)
    kinds = [r["record_type"] for r in warc.read_archives(spark, small).collect() if r["payload_bytes"] == 0]
    assert kinds == ["response"] * 3


def test_files_are_plain_gzip_members(spark, tmp_path):
    folder, out = helpers.write(tmp_path, pages=PAGES), str(tmp_path / "out")
    warc.write_archives(spark.read.parquet(f"{folder}/pages.parquet"), out)
    text = b"".join(gzip.decompress(f) for f in files(out))
    assert text.count(b"WARC-Type: ") == len(PAGES) and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")


def archive(n, compressed, rng):
    out = []
    for k in range(n):
        body = bytes(rng.choices(b"abc <p>\r\n", k=rng.randrange(400)))
        one = warc.record("response", f"urn:x:{k}", "2000-01-01T00:00:00Z", body, page_id=k)
        out.append(gzip.compress(one) if compressed else one)
    return out


def spans(found):
    return [(f.offset, f.length, f.reason is None) for f in found]


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_salvage_recovers_all_records_that_are_not_damaged(compressed, seed):
    rng = random.Random(seed)
    parts = archive(30, compressed, rng)
    hurt = sorted(rng.sample(range(30), 8))
    for k in hurt:
        b = bytearray(parts[k])
        how = rng.randrange(4)
        # without compression only the block is under a digest
        block = 20 if compressed else b.index(b"\r\n\r\n") + 4
        if how == 0:                                    # a byte changes
            at = rng.randrange(block, len(b) - 9)
            b[at] ^= 0x55
        elif how == 1:                                  # cut short
            del b[rng.randrange(5, len(b) - 5):]
        elif how == 2:                                  # the start is overwritten
            b[:20] = bytes(20)
        else:                                           # bytes are put in
            at = rng.randrange(block, len(b) - 9)
            b[at:at] = b"#" * 70
        parts[k] = bytes(b)
    data = b"".join(parts)
    found = list(warc.salvage(data))
    good = [int(f.head["page-id"]) for f in found if f.reason is None]
    assert set(good) <= set(range(30)) and set(range(30)) - set(hurt) <= set(good)
    assert not set(good) & set(hurt)
    at = 0
    for f in found:
        assert f.offset == at and f.length > 0
        at += f.length
    assert at == len(data)
    assert all(f.reason for f in found if f.reason is not None)


def test_gaps_say_why_and_where():
    one, two = archive(2, False, random.Random(1))
    junk = b"junk without a start"
    assert spans(warc.salvage(junk + one + junk + two + junk)) == [
        (0, 20, False), (20, len(one), True), (20 + len(one), 20, False), (40 + len(one), len(two), True),
        (40 + len(one) + len(two), 20, False)]
    assert [f.reason for f in warc.salvage(one[:-30])] == ["no line ends after the block"]
    assert [f.reason for f in warc.salvage(gzip.compress(one)[:-5])] == ["gzip member is cut short"]
    assert [f.reason for f in warc.salvage(gzip.compress(one + two))] == ["member holds more than a record"]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(gzip.compress(b""))) == []
    body = warc.record("response", "urn:x", "2000-01-01T00:00:00Z", b"inner WARC/1.1\r\nnothing", 5)
    bad = body.replace(b"nothing", b"changed")
    found = list(warc.salvage(bad + one))
    assert [f.reason for f in found] == ["warc-block-digest does not hold", None] and found[0].length == len(bad)
    mixed = one + gzip.compress(two) + one
    assert [f.reason for f in warc.salvage(mixed)] == [None] * 3


def test_time_grows_with_the_file_not_its_square():
    import time
    def took(n):
        data = b"".join(archive(n, True, random.Random(2)) + [b"\x1f\x8b\x08 not a member "] * n)
        start = time.perf_counter()
        assert sum(f.reason is None for f in warc.salvage(data)) == n
        return time.perf_counter() - start
    took(100)
    assert took(4000) < 40 * max(took(400), 0.02)


def test_damaged_files_on_disk(spark, tmp_path):
    folder, out = helpers.write(tmp_path, pages=PAGES), str(tmp_path / "out")
    warc.write_archives(spark.read.parquet(f"{folder}/pages.parquet").coalesce(1), out)
    data = bytearray(files(out)[0])
    middle = len(data) // 2
    data[middle:middle + 40] = bytes(40)
    os.makedirs(tmp_path / "hurt")
    (tmp_path / "hurt" / "a.warc.gz").write_bytes(bytes(data))
    got = warc.read_archives(spark, str(tmp_path / "hurt")).collect()
    assert sum(r["reason"] is None for r in got) == len(PAGES) - 1
    gaps = [r for r in got if r["reason"] is not None]
    assert len(gaps) == 1 and gaps[0]["offset"] <= middle < gaps[0]["offset"] + gaps[0]["length"]
