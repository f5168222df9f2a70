from __future__ import annotations

import base64
import gzip
import hashlib
import random

from strata.llm import warc as w


def pages():
    rng = random.Random(2)
    long = "".join(rng.choice("abc <é>\r\n") for _ in range(70_000))
    middle = "".join(rng.choice("xyz") for _ in range(999))
    rows = [
        (1, "http://a/1", long), (2, "http://a/2", long), (9, None, long), (3, "http://a/ü\r\nx y", "é" * 500), (4, "u", "é" * 500), (5, "u", middle),
        (6, "u", middle), (7, "u", None), (8, "u", ""), (10, "u", "WARC/1.1\r\n\r\n0\r\n\r\n" * 200), (None, "u", long), (None, "u", middle + "xx"),
        (None, "u", middle + "xx"), (11, "u", "twice " * 400), (11, "u", "twice " * 400), (-3, "u", "x" * 8192),
    ]
    return rows + [(100 + k, f"http://b/{k}", "p" * rng.randrange(30_000)) for k in range(20)]


def expected(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [i for i, _, other in rows if (other or "") == (html or "") and i is not None]
        origin = max(ids, default=None) if len(data) >= 1000 else None
        revisit = origin is not None and page_id != origin
        out.append((str(page_id), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", str(origin if revisit else None)))
    return sorted(out)


def schema():
    return "page_id long, url string, html string"


def test_round_trip(spark, tmp_path):
    rows = pages()
    for k, segment in enumerate((w.SEGMENT, 100, 1 << 20)):
        w.write_warc(spark.createDataFrame(rows, schema()).repartition(3), str(tmp_path / f"a{k}"), segment=segment)
        got = w.read_pages(spark, str(tmp_path / f"a{k}")).collect()
        assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == expected(rows)
        assert all(r["complete"] for r in got)
        by_id = {}
        for page_id, _, html in rows:
            by_id.setdefault(page_id, []).append((html or "").encode())
        assert all(r["payload"] in by_id[r["page_id"]] for r in got if r["record_type"] == "response")


def test_payloads_are_cut_into_continuations(spark, tmp_path):
    w.write_warc(spark.createDataFrame(pages(), schema()), str(tmp_path / "a"))
    records = w.read_records(spark, str(tmp_path / "a"))
    kinds = {r["type"]: r["n"] for r in records.groupBy("type").count().withColumnRenamed("count", "n").collect()}
    assert kinds["continuation"] > 10 and kinds["revisit"] >= 2
    assert records.filter("length(block) > 8192").count() == 0


def test_lost_segments_show(spark, tmp_path):
    w.write_warc(spark.createDataFrame([(1, "u", "é" * 20_000), (2, "u", "small")], schema()).coalesce(1), str(tmp_path / "a"))
    (file,) = (tmp_path / "a").glob("*.gz")
    data = gzip.decompress(file.read_bytes())
    records = [b"WARC/1.1\r\n" + r for r in data.split(b"WARC/1.1\r\n")[1:]]
    for name, kept in {"lost": records[:2] + records[3:], "last": records[:3] + records[-1:], "twice": records + records[2:3]}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc.gz").write_bytes(gzip.compress(b"".join(kept)))
        got = {r["page_id"]: r for r in w.read_pages(spark, str(tmp_path / name)).collect()}
        assert not got[1]["complete"] and got[1]["payload"] is None
        assert got[2]["complete"] and got[2]["payload"] == b"small"


def test_archives_of_other_writers(spark, tmp_path):
    def record(kind, block, *lines):
        return "\r\n".join(["WARC/1.0", f"WARC-Type:{kind}", *lines, f"content-length:{len(block)}", "", ""]).encode() + block + b"\r\n\r\n"

    def base32(data):
        return "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()

    def target(k):
        return f"WARC-Target-URI:http://c/{k}"

    http, framed = b"HTTP/1.1 200 OK\r\n\r\n", b"HTTP/1.1 200 OK\r\ntransfer-encoding:chunked\r\n\r\n"
    body = w.chunked(b"in chunks")
    records = [
        record("warcinfo", b"software: other\r\n", "WARC-Record-ID: <urn:info>"),
        record("request", b"GET / HTTP/1.1\r\n\r\n", target(1)),
        record("response", http + b"plain", target(1), base32(b"plain")),
        record("metadata", b"a: b\r\n", target(1)),
        record("response", framed + body, target(2), base32(body)),
        record("response", framed + body, target(3)),
        record("response", http + b"changed", target(4), base32(b"before")),
        record("response", http + b"x", target(5), "WARC-Payload-Digest: md5:0"),
        record("response", http + b"x", target(6), "WARC-Payload-Digest: sha1:junk"),
        record("revisit", http, target(7), base32(b"plain"), "WARC-Refers-To: <urn:uuid:1>"),
        record("resource", b"seg", "WARC-Record-ID: <urn:r>", "WARC-Segment-Number: 1"),
        record("continuation", b"ment", "WARC-Segment-Origin-ID: <urn:r>", "WARC-Segment-Number: 2", "WARC-Segment-Total-Length: 7"),
    ]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    got = {int(r["url"][-1]): r for r in w.read_pages(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(1, 8)) and all(r["page_id"] is None for r in got.values())
    assert [got[k]["payload"] for k in range(1, 8)] == [b"plain", b"in chunks", b"in chunks", None, b"x", None, None]
    assert [got[k]["complete"] for k in range(1, 8)] == [True, True, True, False, True, False, True]
    assert got[7]["record_type"] == "revisit" and got[7]["payload_digest"] == got[1]["payload_digest"] == hashlib.sha1(b"plain").hexdigest()
    assert got[7]["refers_to"] is None and got[7]["payload_bytes"] is None


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 4097, 10_000):
        assert w.unchunked(w.chunked(b"x" * n)) == b"x" * n
    assert w.unchunked(b"3;name=value\r\nabc\r\n0\r\n\r\n") == b"abc"
    assert w.unchunked(b"3\r\nab") is None and w.unchunked(b"zz\r\n") is None and w.unchunked(b"") is None


def test_empty_table(spark, tmp_path):
    w.write_warc(spark.createDataFrame([], schema()), str(tmp_path / "a"))
    assert w.read_pages(spark, str(tmp_path / "a")).count() == 0
