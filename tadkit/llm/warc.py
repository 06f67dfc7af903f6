"""WARC archives: capture as whole-file gzip streams, then normalise.

Crawlers may hand over archives that are one gzip stream, which cannot be read
from the middle.  ``capture`` writes such files; ``normalise`` inflates each
stream once, rewrites every record as a gzip member of its own (later copies of
a payload as revisit records) and writes a sidecar index of the members'
offsets; ``read_archives`` reads single records through that index.  Files lie
in a shared folder that pyarrow's file systems can open by URI.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.llm.common import prepare, scratch_path, written

FILE_BYTES = 32 << 20          # payload bytes after which capture starts another file
_READ = 1 << 20
_SPACE = uuid.UUID("6f0f3c52-7d1c-4b3e-9d55-0d6a3b8c1e11")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder URI (a path without a scheme is local)."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri))


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None = None,
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record.  A revisit holds the HTTP head alone, with the length of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>", "WARC-Date": date,
            "WARC-Target-URI": None if url is None else quote(url, safe="%:/?#[]@!$&'()*+,;=~"),
            "WARC-Payload-Digest": f"sha1:{sha}", "Page-ID": page_id}
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To": f"<urn:uuid:{uuid.uuid5(_SPACE, str(refers_to))}>", "Refers-To-Page-ID": refers_to}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)
    return {k: v for k, v in pairs}


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Named fields, payload held here, and length of the full payload."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    named = _fields(head)
    http, payload = rest[:int(named["Content-Length"])].split(b"\r\n\r\n", 1)
    return named, payload, int(_fields(http)["Content-Length"])


def stream_records(source) -> Iterator[bytes]:
    """Records of a gzip stream, inflated once from start to end, one record in memory at a time."""
    inflate, held = zlib.decompressobj(31), bytearray()

    def more() -> bool:
        nonlocal inflate
        raw = inflate.unused_data if inflate.eof else b""
        raw = raw or source.read(_READ)
        if not raw:
            return False
        if inflate.eof:                                  # a stream may consist of several members
            inflate = zlib.decompressobj(31)
        held.extend(inflate.decompress(raw))
        return True
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held:
                    raise ValueError("archive ends within a record")
                return
        size = end + 4 + int(_fields(bytes(held[:end]))["Content-Length"]) + 4
        while len(held) < size:
            if not more():
                raise ValueError("archive ends within a record")
        yield bytes(held[:size])
        del held[:size]


def _member(raw: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def capture(pages: DataFrame, folder: str, level: int = 1, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes all pages as response records into whole-file gzip streams.
    Returns file, number (place in the file), page_id, payload_bytes and
    payload_digest for each record.  File names are new in each attempt of a
    task, so a repeated task leaves no mixture."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        store.create_dir(path, recursive=True)
        out, name, size, number = None, "", 0, 0
        for batch in batches:
            rows: list[tuple] = []
            for page_id, url, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if out is None:
                    name, size, number = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, z = store.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                sha = digest(payload)
                out.write(z.compress(record("response", page_id, url, payload, sha)))
                rows.append((name, number, page_id, len(payload), sha))
                number, size = number + 1, size + len(payload)
                if size >= file_bytes:
                    out.write(z.flush())
                    out.close()
                    out = None
            yield _batch(rows, _CAPTURED)
        if out is not None:
            out.write(z.flush())
            out.close()
    return pages.mapInArrow(run, _CAPTURED)


_CAPTURED = "file string, number long, page_id long, payload_bytes long, payload_digest string"
_ARCHIVE = "archive string, idx string, records long"
_READ_BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, at long"
_TYPES = {"string": pa.string(), "long": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")))
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.record_batch([pa.array(c, _TYPES[t]) for c, t in zip(cols, types)], names=list(names))


def first_copies(captured: DataFrame, least_bytes: int = 0) -> DataFrame:
    """For each file and digest that has its first copy elsewhere or again: the
    first copy of the payload (least page_id, null last; then file and number)."""
    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "file", "number")
    big = captured.where(F.col("payload_bytes") >= least_bytes)
    # Copies within a file are folded first, so that a payload meets itself once a file at most.
    by_file = big.groupBy("payload_digest", "payload_bytes", "file").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    low = by_file.groupBy("payload_digest", "payload_bytes").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    return by_file.select("payload_digest", "payload_bytes", "file").join(low, ["payload_digest", "payload_bytes"]) \
        .select("file", "payload_digest", F.col("first.page_id").alias("page_id"), F.col("first.file").alias("first_file"),
                F.col("first.number").alias("number"))


def normalise(captured: DataFrame, copies: DataFrame, source: str, target: str, level: int = 3) -> DataFrame:
    """Rewrites each captured stream as an archive of one member a record, with
    a sidecar index (JSON lines: offset, length, page_id, type).  One row for
    each file: archive, idx, records.  A task holds the decisions of one file."""
    files = captured.groupBy("file").agg(F.count("*").alias("n"))
    rows = files.select("file", F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("long").alias("page_id"),
                        F.lit(None).cast("string").alias("first_file"), F.lit(None).cast("long").alias("number")).unionByName(copies)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        name = key[0].as_py()
        first = {r["payload_digest"]: r for r in table.to_pylist() if r["payload_digest"] is not None}
        from_fs, from_path = open_folder(source)
        to_fs, to_path = open_folder(target)
        to_fs.create_dir(to_path, recursive=True)
        stem = f"{uuid.uuid4().hex}.warc.gz"
        at = n = 0
        with from_fs.open_input_stream(f"{from_path}/{name}", compression=None) as src, \
                to_fs.open_output_stream(f"{to_path}/{stem}", compression=None) as out, \
                to_fs.open_output_stream(f"{to_path}/{stem}.idx", compression=None) as idx:
            for raw in stream_records(src):
                named, payload, _ = parse_record(raw)
                page_id = int(named["Page-ID"]) if "Page-ID" in named else None
                f, kind = first.get(named["WARC-Payload-Digest"][5:]), "response"
                if f and (f["first_file"], f["number"]) != (name, n):
                    kind = "revisit"
                    raw = record(kind, page_id, named.get("WARC-Target-URI"), payload, named["WARC-Payload-Digest"][5:], f["page_id"])
                member = _member(raw, level)
                out.write(member)
                idx.write((json.dumps({"offset": at, "length": len(member), "page_id": page_id, "type": kind}) + "\n").encode())
                at, n = at + len(member), n + 1
        return pa.Table.from_batches([_batch([(stem, f"{stem}.idx", n)], _ARCHIVE)])
    return rows.groupBy("file").applyInArrow(run, _ARCHIVE)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives, found through their indexes and read as a
    member of its own.  The digest of each payload held is checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        for batch in batches:
            for name, idx in zip(batch.column("archive").to_pylist(), batch.column("idx").to_pylist()):
                rows: list[tuple] = []
                with store.open_input_file(f"{path}/{name}") as f, store.open_input_stream(f"{path}/{idx}", compression=None) as lines:
                    for e in map(json.loads, lines.read().splitlines()):
                        f.seek(e["offset"])
                        named, payload, full = parse_record(zlib.decompress(f.read(e["length"]), 31))
                        kind, sha = named["WARC-Type"], named["WARC-Payload-Digest"][5:]
                        if kind == "response" and digest(payload) != sha:
                            raise ValueError(f"{name}: payload at {e['offset']} differs from its digest")
                        rows.append((e["page_id"], full, sha, kind, int(named["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in named else None,
                                     name, e["offset"]))
                yield _batch(rows, _READ_BACK)
    return archives.select("archive", "idx").mapInArrow(run, _READ_BACK)


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes, normalises and reads back all pages: page_id, payload_bytes,
    payload_digest, record_type, refers_to, archive, at.

    * Null and empty html: an empty payload, a copy of the other empty ones.
    * Ties of page_id: the first record written is the response; a revisit of
      a page without page_id has no refers_to.
    * Null url: no target URI.  Payloads of any length are held one at a time.
    * An empty table writes nothing; extra columns are ignored.
    """
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or scratch_path(spark, "warc")
    captured = written(capture(pages, f"{folder}/captured"), "captured")
    copies = first_copies(captured, least_bytes)
    archives = written(normalise(captured, copies, f"{folder}/captured", f"{folder}/archives"), "archives")
    return read_archives(archives.repartition(spark.sparkContext.defaultParallelism), f"{folder}/archives")
