"""WARC archives: segmented records written and read back, with revisits of equal payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm.common import whole
from tillpoint.session import checkpoint_dir, materialize

#: Greatest block of a record in bytes (longer ones are cut into segments) and greatest number of records of an archive.
SEGMENT, ARCHIVE_RECORDS = 1 << 16, 4096
#: Bytes of a chunk of the transfer coding.
CHUNK = 8192
#: Copies of a group's one response, so that the revisits of a large group meet it in as many places.
SALTS = 32
END = b"\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base 32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer coding."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x" % len(part), END, part, END]
    return b"".join([*parts, b"0", END, END])


def dechunked(body: bytes) -> bytes:
    """What chunked transfer coding frames; chunk extensions and trailers are passed over.

    Raises ``ValueError`` where the framing is broken or has no end.
    """
    parts, at = [], 0
    while True:
        line_end = body.find(END, at)
        if line_end < 0:
            raise ValueError("no chunk size")
        digits = body[at:line_end].split(b";")[0].strip()
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("bad chunk size")
        size, at = int(digits, 16), line_end + 2
        if not size:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != END:
            raise ValueError("chunk cut off")
        parts.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP response message, its transfer coding undone."""
    head, found, body = block.partition(END + END)
    if not found:
        raise ValueError("no end of the HTTP header")
    fields = [line.partition(b":") for line in head.split(END)[1:]]
    codings = [v.strip().lower() for k, _, v in fields if k.strip().lower() == b"transfer-encoding"]
    return dechunked(body) if b"chunked" in codings else body


# ---- writing -------------------------------------------------------------------------------------------------------
def _header(kind: str, record: str, length: int, fields: dict[str, str | None]) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record}>"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return "\r\n".join([*lines, f"Content-Length: {length}", "", ""]).encode("utf-8", "surrogatepass")


def _one_line(value: str) -> str:
    """A header value without control characters, which would end the line: they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def _record_id(archive: str, row: int) -> str:
    return str(uuid.UUID(bytes=hashlib.md5(f"{archive}:{row}".encode()).digest()))


def record_segments(archive: str, row: int, key: str | None, url: str | None, payload: bytes, response: int | None,
                    date: str, segment: int = SEGMENT) -> Iterator[bytes]:
    """The WARC records, each without its final two line ends, of one row: a revisit if ``response`` names another row,
    else a response, cut into continuations where its block is longer than ``segment``."""
    record = _record_id(archive, row)
    fields = {"WARC-Date": date, "WARC-Target-URI": None if url is None else _one_line(url),
              "X-Row-Key": None if key is None else _one_line(key),
              "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
              "Content-Type": "application/http; msgtype=response"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if response is not None:
        fields |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": f"<urn:uuid:{_record_id(archive, response)}>"}
        yield _header("revisit", record, len(head), fields) + head
        return
    block = head + chunked(payload)
    if len(block) <= segment:
        yield _header("response", record, len(block), fields) + block
        return
    starts = range(0, len(block), segment)
    yield _header("response", record, segment, fields | {"WARC-Segment-Number": "1"}) + block[:segment]
    for number, at in enumerate(starts[1:], start=2):
        part = block[at:at + segment]
        yield _header("continuation", str(uuid.UUID(bytes=hashlib.md5(f"{record}:{number}".encode()).digest())), len(part), {
            "WARC-Date": date, "WARC-Segment-Origin-ID": f"<urn:uuid:{record}>", "WARC-Segment-Number": str(number),
            "WARC-Segment-Total-Length": str(len(block)) if at == starts[-1] else None}) + part


def _revisits(rows: DataFrame, least_bytes: int) -> DataFrame:
    """(row, response): rows whose payload another row has too, and that row: the largest key's (ties: the last row)."""
    keys = rows.where(F.octet_length("payload") >= least_bytes).select(
        "row", "key_order", "sha256", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"))
    first = (keys.groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("key_order", "row")).alias("top"))
             .where("n > 1").select(F.col("sha256").alias("r_sha256"), F.col("top.row").alias("response"),
                                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("r_salt")))
    return (keys.join(first, (F.col("sha256") == F.col("r_sha256")) & (F.col("salt") == F.col("r_salt")))
            .where("row <> response").select(F.col("row").alias("v_row"), "response"))


def write_warc(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", segment: int = SEGMENT,
               archive_records: int = ARCHIVE_RECORDS) -> None:
    """Write a record per row to gzipped WARC files under ``path``, through Spark's own writer.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the largest key is a response and the
    others are revisits that refer to it; all others are responses. Payloads are sent in chunked transfer coding; a block
    beyond ``segment`` bytes is cut into continuation records. An archive has at most ``archive_records`` records, so its size
    is bounded, too. Rows are numbered in a written table, so that a task that runs again writes the same records. What
    is compared are SHA-256 digests in a slim table; the payloads meet the revisits by row number, evenly.

    Defined cases: a null payload is an empty one; a null key is smaller than all others and has no header field; a null
    url has none either, control characters in it are percent-encoded; repeated rows each have a record (of equal
    largest keys one row is the response); an empty table writes no records; further columns are ignored.
    """
    archive = uuid.uuid4().hex
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(key_col).alias("key_order"),
                        F.col(key_col).cast("string").alias("key"), F.col(url_col).cast("string").alias("url"),
                        whole(payload_col).cast("binary").alias("payload"))
    rows = materialize(rows.withColumn("sha256", F.sha2("payload", 256)), "warc-rows")
    again = materialize(_revisits(rows, least_bytes), "warc-revisits")
    sent = rows.join(again, F.col("row") == F.col("v_row"), "left").select("row", "key", "url", "payload", "response")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                records = list(record_segments(archive, r["row"], r["key"], r["url"], r["payload"], r["response"], date, segment))
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    (sent.mapInArrow(encode, "record binary").select(F.col("record").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", archive_records).text(path))


# ---- reading -------------------------------------------------------------------------------------------------------
def parse_records(data: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(header fields by lower-case name, block, problem) of every record of a stream of records, by Content-Length."""
    while True:
        line = data.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue  # line ends between records, or what is no record
        fields: dict[str, str] = {}
        name = ""
        while (line := data.readline()).strip():
            text = line.decode("utf-8", "surrogateescape").rstrip("\r\n")
            if text[0] in " \t" and name:
                fields[name] = f"{fields[name]} {text.strip()}".strip()
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
        length = fields.get("content-length", "")
        if not length.isdigit():
            yield fields, b"", "no content length"
            continue
        block = data.read(int(length))
        yield fields, block, None if len(block) == int(length) else "record cut off"


_PARSED = ("record_id string, record_type string, key string, url string, refers_to_id string, digest string, number int, "
           "origin string, total long, block binary, payload_bytes long, payload binary, problem string")


def _finish(block: bytes, digest: str | None) -> tuple[bytes | None, str | None]:
    """(payload, problem) of a whole block of an HTTP response."""
    try:
        payload = http_payload(block)
    except ValueError as e:
        return None, str(e)
    if digest and digest.startswith("sha1:") and digest[5:] != payload_digest(payload):
        return None, "payload digest differs"
    return payload, None


def _stream(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _parsed_rows(content: bytes, with_payload: bool) -> Iterator[dict]:
    for f, block, problem in parse_records(_stream(content)):
        r = {"record_id": f.get("warc-record-id"), "record_type": f.get("warc-type"), "key": f.get("x-row-key"),
             "url": f.get("warc-target-uri"), "refers_to_id": f.get("warc-refers-to"),
             "digest": f.get("warc-payload-digest"), "problem": problem}
        if r["record_type"] == "continuation" or "warc-segment-number" in f:
            number, total = f.get("warc-segment-number", ""), f.get("warc-segment-total-length", "")
            r |= {"number": int(number) if number.isdigit() else 0, "total": int(total) if total.isdigit() else None,
                  "origin": f.get("warc-segment-origin-id") or r["record_id"], "block": block}
        elif r["record_type"] == "response" and not problem:
            payload, r["problem"] = _finish(block, r["digest"])
            if payload is not None:
                r |= {"payload_bytes": len(payload), "payload": payload if with_payload else None}
        yield r


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{c: r.get(c) for c in schema.names} for r in rows], schema=schema)


_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("key", pa.string()), ("url", pa.string()),
                    ("refers_to_id", pa.string()), ("digest", pa.string()), ("number", pa.int32()), ("origin", pa.string()),
                    ("total", pa.int64()), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
                    ("problem", pa.string())])


def reassembled(segments: pa.Table, with_payload: bool = True) -> pa.Table:
    """The one record of the segments of an origin: in order of the segment number, of the stated total length.

    Segments found twice count once. A missing first, inner or last segment, segments that differ under one number and a
    wrong total length are problems; such a record has no payload.
    """
    rows = segments.to_pylist()
    by_number: dict[int, dict] = {}
    problem = next((r["problem"] for r in rows if r["problem"]), None)
    for r in rows:
        if by_number.setdefault(r["number"], r)["block"] != r["block"]:
            problem = problem or f"segment {r['number']} is not unique"
    first = by_number.get(1)
    out = dict(first or {"record_id": rows[0]["origin"], "record_type": "continuation"}, number=None, total=None, block=None,
               payload=None, payload_bytes=None)
    totals = {r["total"] for r in rows if r["total"] is not None}
    numbers = sorted(by_number)
    block = b"".join(by_number[n]["block"] for n in numbers)
    if first is None:
        problem = problem or "first segment missing"
    elif numbers != list(range(1, len(numbers) + 1)):
        problem = problem or "segment missing"
    elif len(totals) != 1:
        problem = problem or "last segment missing"
    elif totals != {len(block)}:
        problem = problem or "wrong total length"
    payload = None
    if problem is None and out["record_type"] == "response":
        payload, problem = _finish(block, out["digest"])
    out |= {"problem": problem, "payload_bytes": None if payload is None else len(payload),
            "payload": payload if with_payload else None}
    return pa.Table.from_batches([_table([out], _ARROW)])


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(record_id, record_type, key, url, refers_to_id, digest, payload_bytes, payload, problem) of every record under
    ``path``: plain or gzipped archives (any number of gzip members), whose records are cut by their Content-Length.

    Continuations are brought to their origin and joined; one record is held at a time. Whole records need no shuffle. A
    task holds one archive in memory. A record that cannot be read has a ``problem`` and no payload; other kinds of records
    (warcinfo, request, metadata) come out without a payload. Without ``with_payload`` the column is null.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for r in _parsed_rows(content.as_py(), with_payload):
                    rows.append(r)
                    held += len(r.get("block") or b"") + len(r.get("payload") or b"")
                    if held > 1 << 23 or len(rows) >= 4096:
                        yield _table(rows, _ARROW)
                        rows, held = [], 0
                yield _table(rows, _ARROW)

    parsed = materialize(files.mapInArrow(parse, _PARSED), "warc-records")
    joined = parsed.where("origin IS NOT NULL").groupBy("origin").applyInArrow(
        lambda t: reassembled(t, with_payload), _PARSED)
    return parsed.where("origin IS NULL").unionByName(joined).drop("number", "origin", "total", "block")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Responses and revisits of ``read_warc``, revisits with ``refers_to`` (the response's key) and its payload size.

    Only responses that something refers to are copied to the salts of a join of slim rows. A revisit whose response is
    missing, broken or of another digest has a ``problem``.
    """
    slim = materialize(records.select("record_id", "record_type", "key", "url", "refers_to_id", "digest", "payload_bytes",
                                      "problem"), "warc-slim")
    revisits = slim.where("record_type = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    asked = revisits.select(F.col("refers_to_id").alias("asked")).distinct()
    responses = (slim.where("record_type = 'response'").join(asked, F.col("record_id") == F.col("asked"), "left_semi")
                 .select(F.col("record_id").alias("r_id"), F.col("key").alias("refers_to"), F.col("digest").alias("r_digest"),
                         F.col("payload_bytes").alias("r_bytes"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("r_salt")))
    found = revisits.join(responses, (F.col("refers_to_id") == F.col("r_id")) & (F.col("salt") == F.col("r_salt")), "left")
    wrong = F.when(F.col("r_bytes").isNull(), F.lit("response missing or broken")).when(
        ~F.col("digest").eqNullSafe(F.col("r_digest")), F.lit("digest differs from the response's"))
    columns = ["record_id", "record_type", "key", "url", "digest"]
    found = found.select(*columns, F.when(wrong.isNull(), F.col("r_bytes")).alias("payload_bytes"), "refers_to",
                         F.coalesce("problem", wrong).alias("problem"))
    return found.unionByName(slim.where("record_type = 'response'").select(
        *columns, "payload_bytes", F.lit(None).cast("string").alias("refers_to"), "problem"))


def archive_and_read(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                     least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives (``path``, else a folder of their own in the shared one) and read the records back."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex[:12]}"
    write_warc(pages, path, key_col, url_col, payload_col, least_bytes)
    return resolve_revisits(read_warc(spark, path, with_payload=False))
