"""WARC archives: writing pages as records, and reading them back with segment reassembly.

Writing. Each page is a record whose block is an HTTP response with chunked transfer framing. Blocks over ``segment``
bytes go on in continuation records, which may come to lie in other archives. Pages that repeat a payload refer to the one
with the largest page_id. Archives are gzip files of at most ``RECORDS`` records, so that each can be read whole.

Reading. Archives are parsed by the lengths in their headers. Only records of segmented blocks are shuffled: they are
grouped by the identifier of the origin, ordered by segment number and checked against the total length. Then the chunked framing is
decoded, and the payload is checked against its digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stash, utf8

SEGMENT = 8192
CHUNK = 4096
RECORDS = 1000
#: Payloads from this size on are stored once.
LEAST_REVISIT = 1000
#: Origins of repeated payloads are sent to all tasks up to this number (about 100 bytes each).
SENT_ORIGINS = 200_000
END = "\r\n\r\n"
OUT_BYTES = 4 << 20

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "record_id string, type string, page_id long, url string, digest string, refers_to long, length long, segment int, origin string, total long, block binary"
_FIELDS = [part.split()[0] for part in _RECORD.split(", ")]


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, None if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = body[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), line + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", len(block))] if value is not None]
    return ("WARC/1.1\r\n" + "".join(lines) + "\r\n").encode() + block


def _records(name: str, page_id: int | None, url: str | None, payload: bytes, digest: str, origin: int | None, date: str, segment: int) -> Iterator[bytes]:
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else None
    head = [("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date), ("WARC-Target-URI", target), ("Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = [("Content-Type", "application/http;msgtype=response")]
    if origin is not None:
        more = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{origin}>"), ("Payload-Length", len(payload))]
        yield _record([("WARC-Type", "revisit"), *head, *more, *http], _HTTP + b"\r\n")
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment:
        yield _record([("WARC-Type", "response"), *head, *http], block)
        return
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield _record([("WARC-Type", "response"), *head, ("WARC-Segment-Number", 1), *http], parts[0])
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        ids = [("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", f"<{name}>")]
        yield _record([("WARC-Type", "continuation"), *ids, ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)], part)


def _gathered(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``OUT_BYTES``."""
    kept, total = [], 0
    for row in rows:
        kept.append(row)
        total += size(row)
        if total >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept, strict=True), schema, strict=True)], schema=schema)
            kept, total = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept, strict=True), schema, strict=True)], schema=schema)


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", segment: int = SEGMENT) -> None:
    """One record (and its continuations) for each row of ``pages`` (page_id, url, html) into gzip archives in ``path``.

    The payload is the html in UTF-8; NULL is empty. Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, those with the
    largest page_id are stored, others are revisits of it; if all their ids are NULL, all are stored. Control characters in a url are
    percent-encoded. Rows that repeat a page_id have records of their own. An empty table gives archives without a record.
    """
    payloads = pages.select("page_id", "url", utf8("html").alias("payload")).withColumn("digest", F.sha1("payload"))
    large = payloads.filter(F.octet_length("payload") >= LEAST_REVISIT)
    origins = large.groupBy("digest").agg(F.max("page_id").alias("origin"), F.count("*").alias("n")).filter("n > 1")
    origins = stash(origins.select("digest", "origin"), "origins")
    if origins.count() <= SENT_ORIGINS:
        origins = F.broadcast(origins)
    marked = payloads.join(origins, "digest", "left")
    # short payloads can't have the digest of a long one
    stored = F.col("origin").isNull() | F.col("page_id").eqNullSafe(F.col("origin"))
    marked = marked.select("page_id", "url", "payload", "digest", F.when(~stored, F.col("origin")).alias("origin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0

        def rows() -> Iterator[tuple]:
            nonlocal n
            for batch in batches:
                for page_id, url, payload, digest, origin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    n += 1
                    for record in _records(f"urn:page:{page_id}:{part}:{n}", page_id, url, payload, digest, origin, date, segment):
                        yield (record,)

        yield from _gathered(rows(), pa.schema([("record", pa.binary())]), lambda row: len(row[0]))

    records = marked.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    # the line end of this text writer is what ends a record
    records.write.option("maxRecordsPerFile", RECORDS).text(path, compression="gzip", lineSep=END)


def _sha1(digest: str | None) -> str | None:
    """The lower-case hex of a labelled SHA-1 digest in hex or base32, and what else it says as it is; None for other algorithms."""
    name, _, value = (digest or "").strip().partition(":")
    if name.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", value) else value.lower()


def _parse(data: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError("not a WARC record")
        lines = data[at:end].decode(errors="replace").split("\r\n")[1:]
        head = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        start = end + 4
        length = int(head["content-length"])
        at = start + length + 4
        if len(data) < at or data[at - 4 : at] != b"\r\n\r\n":
            raise ValueError("a record is shorter than its header says")

        def number(name: str, head=head) -> int | None:
            return int(head[name]) if name in head else None

        refers = re.fullmatch(r"<urn:page:(-?\d+)>", head.get("warc-refers-to", ""))
        yield (
            head.get("warc-record-id"),
            head.get("warc-type"),
            number("page-id"),
            head.get("warc-target-uri"),
            _sha1(head.get("warc-payload-digest")),
            int(refers[1]) if refers else None,
            number("payload-length"),
            number("warc-segment-number"),
            head.get("warc-segment-origin-id"),
            number("warc-segment-total-length"),
            data[start : start + length],
        )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in ``path``, one row each."""
    schema = pa.schema(
        [(f, {"page_id": pa.int64(), "refers_to": pa.int64(), "length": pa.int64(), "segment": pa.int32(), "total": pa.int64(), "block": pa.binary()}.get(f, pa.string())) for f in _FIELDS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for content in batch.column("content"):
                    yield from _parse(gzip.decompress(content.as_py()))

        yield from _gathered(rows(), schema, lambda row: len(row[-1]) + 200)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _RECORD)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type (response or revisit), payload, payload_bytes, payload_digest, refers_to, complete.

    ``complete`` is false, and the payload NULL, if segments are missing or repeated, their total length is wrong, the chunked framing is
    broken or the digest differs. Revisits have no payload of their own; size and digest come from their header.

    Archives of other writers: records that are neither response nor revisit are passed over, whole or segmented. page_id is NULL where
    the header has none, as are refers_to and size of a revisit. Digests may be SHA-1 in hex or base32, of the payload or of the body in
    its framing; one of another algorithm is not checked, nor is a missing one. payload_digest is always the hex SHA-1 of the payload.
    """
    records = read_records(spark, path)
    whole = records.filter("segment is null and type in ('response', 'revisit')").select("page_id", "url", "type", "digest", "refers_to", "length", F.lit(True).alias("joined"), F.array("block").alias("blocks"))
    # one group is one payload
    parts = (
        records.filter("segment is not null")
        .groupBy(F.coalesce("origin", "record_id").alias("id"))
        .agg(
            *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("page_id", "url", "digest", "type")],
            F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        )
        .filter("coalesce(type, 'response') = 'response'")
    )
    numbered = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    joined = F.coalesce(numbered & (size == F.col("total")), F.lit(False))
    again = parts.select(
        "page_id", "url", F.lit("response").alias("type"), F.col("digest"), F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("long").alias("length"), joined.alias("joined"), F.transform("parts", lambda p: p["block"]).alias("blocks")
    )
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("complete", pa.bool_())]
    )

    def decoded(page_id, url, kind, digest, refers_to, length, joined, blocks) -> tuple:
        if kind == "revisit":
            return page_id, url, kind, None, length, digest, refers_to, True
        block = b"".join(blocks)
        head, _, body = block.partition(b"\r\n\r\n")
        payload = unchunked(body) if re.search(rb"(?m)^transfer-encoding:[ \t]*chunked", head.lower()) else body
        own = None if payload is None else hashlib.sha1(payload).hexdigest()
        if not joined or own is None or digest not in (None, own) and digest != hashlib.sha1(body).hexdigest():
            return page_id, url, kind, None, None, digest, None, False
        return page_id, url, kind, payload, len(payload), own, None, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (decoded(*row) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        yield from _gathered(rows, schema, lambda row: len(row[3] or b"") + 100)

    out = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, complete boolean"
    return whole.union(again).mapInArrow(run, out)


SQL = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
m AS (SELECT *, CASE WHEN n >= {LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS origin FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> origin THEN origin END AS refers_to, true AS complete
FROM m
"""
