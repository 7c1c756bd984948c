"""WARC archives: round trips, revisits, and records that cannot be put together."""

import gzip
import io
import os
import random
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillpoint.llm import warc
from tillpoint.llm.common import prepare

LONG = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9_000  # over 300,000 bytes, with what looks like records
PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, None, None), (3, "http://a/3", ""), (4, "http://b/\r\nX-Row-Key: 9", "<p>one</p>"),
    (5, "http://ü/5", "é \U0001f600\r\n0\r\n\r\n"), (6, "http://a/6", LONG), (7, "http://a/7", LONG), (7, "http://a/7", LONG),
    (None, "http://a/n", "<p>one</p>"), (None, None, "null id alone"), (10, "http://a/10", "A" * 70_000), (11, "u", "tail"),
]
KIND = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    prepare(spark)
    extra = ("row", "response", "payload", "key", "sha256", "value", "block", "origin", "r_id")
    return spark.createDataFrame(PAGES, KIND).withColumns({c: F.lit(7) for c in extra})


def folder():
    return tempfile.mkdtemp(prefix="tillpoint-test-warc-")


def test_round_trip_and_revisits(spark, pages):
    path = folder()
    warc.write_warc(pages, path, segment=4096, archive_records=7)
    read = warc.read_warc(spark, path).collect()
    assert not [r.problem for r in read if r.problem]
    by_payload = {}
    for i, _, html in PAGES:
        by_payload.setdefault(html or "", []).append(i)
    assert sorted(bytes(r.payload).decode() for r in read if r.record_type == "response") == sorted(by_payload)
    assert len(read) == len(PAGES) and len({r.record_id for r in read}) == len(PAGES)
    out = warc.resolve_revisits(warc.read_warc(spark, path)).collect()
    got = sorted((r.key or "", r.payload_bytes, r.digest, r.record_type, r.refers_to or "") for r in out)
    want = []
    for html, ids in by_payload.items():
        top = max(ids, key=lambda i: -1 if i is None else i)
        data = html.encode()
        left = list(ids)
        left.remove(top)
        name = lambda i: "" if i is None else str(i)
        digest = "sha1:" + warc.payload_digest(data)
        want += [(name(top), len(data), digest, "response", "")]
        want += [(name(i), len(data), digest, "revisit", name(top)) for i in left]
    assert got == sorted(want) and not [r.problem for r in out if r.problem]
    assert {r.url for r in out if r.key == "4"} == {"http://b/%0D%0AX-Row-Key: 9"}
    # segments lie in several archives, each is a gzip file of bounded records, and a plain reader agrees
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".gz")]
    kinds = [[f["warc-type"] for f, _, problem in warc.parse_records(gzip.open(x)) if not problem] for x in files]
    assert max(map(len, kinds)) <= 7 and sum(k.count("continuation") for k in kinds) > 70
    assert sum("continuation" in k for k in kinds) > 9


def test_short_payloads_and_empty_tables(spark, pages):
    out = warc.archive_and_read(pages, least_bytes=11, path=folder()).collect()
    assert sorted(r.key for r in out if r.record_type == "revisit" and r.key) == ["6", "7"]
    assert sum(r.record_type == "response" for r in out) == len(PAGES) - 2
    assert warc.archive_and_read(pages.where("false"), path=folder()).count() == 0


def test_chunks():
    rng = random.Random(5)
    for n in (0, 1, 8191, 8192, 8193, 50_000):
        data = rng.randbytes(n)
        for size in (1000, 8192):
            assert warc.dechunked(warc.chunked(data, size)) == data
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n00\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"3\r\nab", b"zz\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"-1\r\n\r\n", b"\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nContent-Type: x\r\n\r\nplain\r\n0\r\n") == b"plain\r\n0\r\n"


def records_of(payload=b"p" * 10_000):
    return list(warc.record_segments("a", 1, "1", "u", payload, None, "2000-01-01T00:00:00Z", segment=3000))


def read(spark, *chunks, gz=False):
    path = folder()
    data = b"".join(chunks)
    with open(f"{path}/one.warc", "wb") as f:
        f.write(gzip.compress(data) if gz else data)
    return warc.read_warc(spark, path).collect()


def test_broken_archives(spark):
    prepare(spark)
    end = b"\r\n\r\n"
    whole = records_of()
    assert len(whole) == 4
    ok, = read(spark, *[x + end for x in (whole[3], whole[1], whole[0], whole[2], whole[1])])  # any order, one twice
    assert bytes(ok.payload) == b"p" * 10_000 and ok.problem is None and ok.payload_bytes == 10_000
    for left, problem in ((whole[1:], "first segment missing"), (whole[:1] + whole[2:], "segment missing"),
                          (whole[:3], "last segment missing")):
        r, = read(spark, *[x + end for x in left])
        assert r.problem == problem and r.payload is None and r.payload_bytes is None
    wrong = whole[3].replace(b"Total-Length: 1", b"Total-Length: 2")
    r, = read(spark, *[x + end for x in (*whole[:3], wrong)])
    assert r.problem == "wrong total length"
    other = records_of(b"q" * 10_000)
    r, = read(spark, *[x + end for x in (*whole, other[1])])
    assert r.problem == "segment 2 is not unique"
    small = list(warc.record_segments("a", 2, "2", "u", b"small", None, "d"))[0]
    broken = small.replace(b"small\r\n", b"smalL\r\n")
    got = read(spark, b"noise\r\n", small + end, broken + end, b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi",
               end, b"WARC/1.0\r\nWARC-Type: response\r\n\r\n", small[:-4], gz=True)
    assert [(r.record_type, r.problem) for r in got] == [
        ("response", None), ("response", "payload digest differs"), ("warcinfo", None), ("response", "no content length"),
        ("response", "record cut off")]
    folded = b"WARC/1.1\r\nWARC-Type:\r\n response\r\nContent-Length: 0\r\n\r\n"
    assert next(warc.parse_records(io.BytesIO(folded)))[0]["warc-type"] == "response"


def test_revisits_without_their_response(spark):
    prepare(spark)
    end = b"\r\n\r\n"
    first = list(warc.record_segments("a", 1, "1", "u", b"same", None, "d"))[0]
    again = list(warc.record_segments("a", 2, "2", "u", b"same", 1, "d"))[0]
    lost = list(warc.record_segments("a", 3, "3", "u", b"same", 9, "d"))[0]
    odd = list(warc.record_segments("a", 4, "4", "u", b"else", 1, "d"))[0]
    path = folder()
    with open(f"{path}/x.warc", "wb") as f:
        f.write(b"".join(x + end for x in (again, lost, odd, first)))
    out = {r.key: (r.refers_to, r.payload_bytes, r.problem) for r in warc.resolve_revisits(warc.read_warc(spark, path)).collect()}
    assert out == {"1": (None, 4, None), "2": ("1", 4, None), "3": (None, None, "response missing or broken"),
                   "4": ("1", None, "digest differs from the response's")}


def test_group_of_many_copies(spark):
    prepare(spark)
    rows = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                    F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("html"))
    out = warc.archive_and_read(rows, path=folder())
    again = out.where("record_type = 'revisit'")
    assert again.count() == 999 and {r.refers_to for r in again.select("refers_to").distinct().collect()} == {"2997"}
    assert out.where("problem IS NOT NULL").isEmpty() and out.count() == 3000


def test_reassembled_needs_no_payload():
    kind = pa.schema([f for f in warc._ARROW])
    rows = [{"record_id": "o", "record_type": "response", "key": "1", "digest": "sha1:" + warc.payload_digest(b"ab"),
             "number": 1, "origin": "o", "block": b"HTTP/1.1 200 OK\r\n\r\na"},
            {"record_id": "c", "record_type": "continuation", "number": 2, "origin": "o", "total": 21, "block": b"b"}]
    out = warc.reassembled(pa.Table.from_pylist(rows, schema=kind), with_payload=False).to_pylist()[0]
    assert out["payload_bytes"] == 2 and out["payload"] is None and out["problem"] is None
