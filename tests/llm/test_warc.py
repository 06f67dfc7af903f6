"""WARC: what is read back equals the pages; members and index agree."""

import base64
import gzip
import hashlib
import io
import json
import os
import zlib

from tadkit.llm.warc import archive_pages, parse_record, record, stream_records

SMALL = "/root/testdata/sf0.001"


def brute(pages, least):
    first = {}
    for r in sorted(pages, key=lambda r: r.page_id):
        first.setdefault((r.html or "").encode(), r.page_id)
    out = {}
    for r in pages:
        raw = (r.html or "").encode()
        f = first[raw] if len(raw) >= least else r.page_id
        kind = "response" if f == r.page_id else "revisit"
        out[r.page_id] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, None if f == r.page_id else f)
    return out


def test_pages(spark, tmp_path):
    p = spark.read.parquet(f"{SMALL}/pages.parquet")
    extra = spark.createDataFrame([(100_000, None, None), (100_001, "u", ""), (100_002, "http://é/ \r\n", "tiny"), (100_003, "u", "tiny"),
                                   (100_004, "u", "y" * 3_000_000)], "page_id long, url string, html string")
    twice = p.limit(20).selectExpr("page_id + 200000 as page_id", "url", "html")
    rows = p.unionByName(extra).unionByName(twice).repartition(4)
    got = {r.page_id: tuple(r)[1:5] for r in archive_pages(rows, str(tmp_path / "a")).collect()}
    assert got == brute(rows.collect(), 0)
    got = {r.page_id: tuple(r)[1:5] for r in archive_pages(rows, str(tmp_path / "b"), least_bytes=5).collect()}
    assert got == brute(rows.collect(), 5)


def test_files_on_disk(spark, tmp_path):
    p = spark.read.parquet(f"{SMALL}/pages.parquet")
    archive_pages(p, str(tmp_path)).count()
    for name in os.listdir(tmp_path / "captured"):
        raw = (tmp_path / "captured" / name).read_bytes()
        z = zlib.decompressobj(31)
        z.decompress(raw)
        assert z.eof and not z.unused_data                      # one stream for the whole file
    for name in os.listdir(tmp_path / "archives"):
        if name.endswith(".gz"):
            raw = (tmp_path / "archives" / name).read_bytes()
            index = [json.loads(line) for line in (tmp_path / "archives" / f"{name}.idx").read_text().splitlines()]
            parts = [gzip.decompress(raw[e["offset"]:e["offset"] + e["length"]]) for e in index]
            assert b"".join(parts) == gzip.decompress(raw) and sum(e["length"] for e in index) == len(raw)
            assert list(stream_records(io.BytesIO(raw))) == parts


def test_edge_cases(spark, tmp_path):
    d = spark.createDataFrame([(None, None, "a", 1), (3, "u", "a", 2), (3, "u", "a", 3)], "page_id long, url string, html string, at int")
    got = sorted((r.page_id or -1, r.record_type, r.refers_to or -1) for r in archive_pages(d, str(tmp_path / "a")).collect())
    assert got == [(-1, "revisit", 3), (3, "response", -1), (3, "revisit", 3)]
    assert archive_pages(d.limit(0), str(tmp_path / "b")).collect() == []


def test_record_round_trip():
    raw = record("response", 5, "http://x/ y", b"\r\n\r\npay\r\n\r\nload", "AAA")
    named, payload, size = parse_record(raw)
    assert payload == b"\r\n\r\npay\r\n\r\nload" and size == len(payload) and named["WARC-Type"] == "response"
    named, payload, size = parse_record(record("revisit", 6, None, b"pay", "AAA", 5))
    assert payload == b"" and size == 3 and named["Refers-To-Page-ID"] == "5"
